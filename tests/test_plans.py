"""What the plans must and must not contain."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from turntable.checks.registered import CONFIG, EVENTS_NOW
from turntable.operators import candidates, dimensions, stats
from turntable.operators.joins import fan_out_join
from turntable.sources import adapters
from turntable.sources import listens as table
from turntable.sources.tables import materialise


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return adapters.listens_from_events(spark, sf_dir)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_time_windows_reach_the_scan(events):
    for df in (table.recent_listens(events, EVENTS_NOW, 7), table.listens_of_year(events, 2024), table.scan_months(events, EVENTS_NOW, EVENTS_NOW)):
        assert "GreaterThanOrEqual(ts,2024-01" in plan(df)


def test_month_scan_prunes_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("u", datetime(2019, m, 1)) for m in range(1, 13)], "user_name string, listened_at timestamp")
    table.write_listens(table.with_month(rows), path)
    scan = table.scan_months(table.read_listens(spark, path), datetime(2019, 3, 1), datetime(2019, 4, 9)).select("user_name")
    text = plan(scan)
    assert "PartitionFilters: [((year" in text and "ReadSchema: struct<user_name:string>" in text
    assert scan.count() == 2


def test_top_artists_are_cut_before_the_shuffle(events):
    text = plan(candidates.top_artists(events, 5))
    assert text.count("WindowGroupLimit") == 2 and "partial_count" in text


def test_similar_artists_are_cut_before_the_shuffle(spark, sf_dir):
    assert plan(candidates.similar_artists(adapters.relation_from_events(spark, sf_dir), 3)).count("WindowGroupLimit") == 2


def test_counts_are_one_shuffle_with_partial_aggregation(events):
    for count in (stats.user_artists, stats.user_recordings, stats.user_releases):
        text = plan(count(events))
        assert text.count("Exchange") == 1 and "partial_count" in text


def test_playcounts_shuffle_pairs_not_listens(events, no_broadcast):
    listens = materialise(events)
    users, recordings = materialise(dimensions.users_dim(listens)), materialise(dimensions.recordings_dim(listens))
    text = plan(dimensions.playcounts(listens, users, recordings))
    # One for the pairs, then two per lookup join.
    assert text.count("Exchange") == 5
    assert text.count("HashAggregate") == 2


def test_fan_out_join_needs_no_further_shuffle(spark, no_broadcast):
    left = materialise(spark.range(100).select(F.lit("k").alias("k"), F.col("id").alias("u")))
    right = materialise(spark.range(100).select(F.lit("k").alias("k"), F.col("id").alias("v")))
    for pairs in (10, 1_000_000):
        text = plan(fan_out_join(left, right, "k", pairs))
        assert text.count("Exchange hashpartitioning") == 2


def test_configuration_of_the_queries_keeps_the_defaults_otherwise():
    assert (CONFIG.ranks, CONFIG.lambdas, CONFIG.iterations, CONFIG.alpha) == ((8, 12), (0.1, 10.0), (10, 20), 3.0)
