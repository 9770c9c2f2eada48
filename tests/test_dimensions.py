import pytest
from pyspark.sql import functions as F

from turntable.operators import dimensions
from turntable.sources.tables import materialise

LISTEN = (
    "user_name string, track_name string, recording_msid string, artist_name string, artist_msid string, "
    "release_name string, release_msid string"
)


def listens(spark, *plays):
    rows = [(user, f"t-{r}", r, "A", "a", release, release) for user, r, release in plays]
    return spark.createDataFrame(rows, LISTEN)


def as_set(df):
    return {tuple(row) for row in df.collect()}


def test_playcounts(spark):
    plays = listens(spark, ("u1", "r1", "x"), ("u1", "r1", "x"), ("u2", "r2", "x"), ("u2", "r3", "x"), ("u3", "r2", "x"))
    users, recordings = dimensions.users_dim(plays), dimensions.recordings_dim(plays)
    assert as_set(users) == {("u1", 1), ("u2", 2), ("u3", 3)}
    assert {(row.recording_msid, row.recording_id) for row in recordings.collect()} == {("r1", 1), ("r2", 2), ("r3", 3)}
    assert as_set(dimensions.playcounts(plays, users, recordings)) == {(1, 1, 2), (2, 2, 1), (2, 3, 1), (3, 2, 1)}


@pytest.mark.parametrize("many", [1, 100])
def test_variants_of_an_msid_all_count(spark, monkeypatch, many):
    monkeypatch.setattr(dimensions, "_MANY_VARIANTS", many)
    plays = listens(spark, ("u1", "r1", "x"), ("u1", "r1", "y"), ("u1", "r1", None), ("u2", "r2", "x"))
    users, recordings = dimensions.users_dim(plays), dimensions.recordings_dim(plays)
    counts = dimensions.playcounts(plays, users, recordings)
    assert counts.columns == ["user_id", "recording_id", "count"]
    # NULL sorts first, so the variant without a release has id 1.
    assert as_set(counts) == {(1, 1, 3), (1, 2, 3), (1, 3, 3), (2, 4, 1)}


def test_listens_outside_the_dimensions_are_dropped(spark):
    plays = listens(spark, ("u1", "r1", "x"), (None, "r1", "x"), ("u2", None, "x"))
    users = spark.createDataFrame([("u1", 5)], "user_name string, user_id int")
    recordings = dimensions.recordings_dim(plays)
    by_msid = {row.recording_msid: row.recording_id for row in recordings.collect()}
    assert as_set(dimensions.playcounts(plays, users, recordings)) == {(5, by_msid["r1"], 1)}


def test_user_lookup(spark):
    users = spark.createDataFrame([("U", 1), ("O'Brien \"X\"", 2)], "user_name string, user_id int")
    names = spark.createDataFrame([("U",), ("U",), ("nobody",), ("O'Brien \"X\"",)], "user_name string")
    assert as_set(dimensions.user_ids(names, users)) == {("U", 1), ("O'Brien \"X\"", 2)}
    assert as_set(dimensions.unknown_users(names, users)) == {("nobody",)}


def test_audit_of_one_user(spark):
    counts = spark.createDataFrame([(3, 1, 1), (5, 1, 2), (9, 2, 1)], "play_count long, user_id int, recording_id int")
    users = spark.createDataFrame([("rob", 1), ("ann", 2)], "user_name string, user_id int")
    recordings = spark.createDataFrame([("m1", "T1", 1), ("m2", "T2", 2)], "recording_mbid string, track_name string, recording_id int")
    audit = [tuple(row) for row in dimensions.playcount_audit(counts, users, recordings, "rob").collect()]
    assert audit == [(5, "rob", 1, 2, "T2"), (3, "rob", 1, 1, "T1")]


def test_mbid_playcounts_are_sorted(spark):
    rows = [("u", "m1", "T"), ("u", "m2", "T"), ("u", "m2", "T"), ("v", "m1", "T"), ("v", "m1", "T2")]
    plays = spark.createDataFrame(rows, "user_name string, recording_mbid string, track_name string")
    users, recordings = dimensions.users_dim(plays), dimensions.mbid_recordings_dim(plays)
    counts = [tuple(row) for row in dimensions.playcounts_by_mbid(plays, users, recordings).collect()]
    # m1 has two track names, so its listens count under both.
    assert counts == [(2, 1, 3), (1, 1, 1), (1, 1, 2), (2, 2, 1), (2, 2, 2)]


def test_hot_user_is_split_by_adaptive_execution(spark):
    """A user with most of the plays: the lookup join splits, and the counts stay right."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    user = F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 1000))
    msid = F.concat(F.lit("r"), F.col("id"))
    plays = materialise(
        spark.range(200_000).select(
            user.alias("user_name"), F.lit("t").alias("track_name"), msid.alias("recording_msid"),
            F.lit("A").alias("artist_name"), F.lit("a").alias("artist_msid"), F.lit("x").alias("release_name"),
            F.lit("x").alias("release_msid"),
        )
    )
    users, recordings = materialise(dimensions.users_dim(plays)), materialise(dimensions.recordings_dim(plays))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        counts = dimensions.playcounts(plays, users, recordings)
        assert counts.agg(F.count("*"), F.sum("count")).collect() == [(200_000, 200_000)]
        counted = counts.groupBy("user_id").count()
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
