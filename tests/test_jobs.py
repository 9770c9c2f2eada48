"""The jobs end to end, over one small root folder."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from turntable.config import EngineConfig, Layout
from turntable.operators import als
from turntable.plans import jobs
from turntable.schemas import MBID_LISTEN, MODEL_METADATA
from turntable.sources.tables import overwrite, read_table

NOW = datetime(2019, 7, 15, 12)
CFG = EngineConfig(ranks=(2,), lambdas=(0.1, 1.0), iterations=(3,), top_artists_limit=2, similar_artists_limit=2)


def line(i, day):
    artist = i % 7
    return {
        "artist_mbids": [], "artist_msid": f"a{artist}", "artist_name": f"artist {artist}",
        "listened_at": f"2019-{day} 10:00:{i % 60:02d}", "recording_mbid": "", "recording_msid": f"r{artist}-{i % 3}",
        "release_mbid": "", "release_msid": "", "release_name": "", "tags": [], "track_name": f"t{artist}-{i % 3}",
        "user_name": f"user {i * 5 % 11}",
    }


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("root")
    dump = root / "dump" / "2019"
    dump.mkdir(parents=True)
    for month, day in ((1, "01-10"), (5, "05-03"), (7, "07-12")):
        (dump / f"{month}.json").write_text("\n".join(json.dumps(line(i, day)) for i in range(150)))
    (dump.parent / "invalid.json").write_text(json.dumps(line(1, "07-12")))
    layout = Layout(str(root))
    jobs.import_listens(spark, str(root / "dump"), layout)
    edges = [(f"artist {i}", f"artist {(i + 1) % 7}", 10 - i) for i in range(7)]
    overwrite(spark.createDataFrame(edges, "artist_name_0 string, artist_name_1 string, count long"), layout.artists_relation)
    return layout


@pytest.fixture(scope="module")
def built(spark, layout):
    # 180 days before the 15th of July are in January, whose listens count from its first day.
    return jobs.create_dataframes(spark, layout, NOW, CFG)


@pytest.fixture(scope="module")
def trained(spark, layout, built):
    return jobs.train_models(spark, layout, CFG)


@pytest.fixture(scope="module")
def with_candidates(spark, layout, built):
    jobs.build_candidate_sets(spark, layout, NOW, CFG)


def test_import(spark, layout):
    assert jobs.month_row_count(spark, layout, 2019, 1) == 150
    assert jobs.month_row_count(spark, layout, 2019, 2) == 0


def test_import_of_raw_listens(spark, tmp_path):
    info = {"artist_name": "A", "track_name": "T", "additional_info": {"artist_msid": "a"}}
    raw = {"listened_at": 1563000000, "user_name": "u", "recording_msid": "r", "track_metadata": info}
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "1.json").write_text(json.dumps(raw))
    other = Layout(str(tmp_path))
    jobs.import_listens(spark, str(tmp_path / "raw"), other, raw=True)
    assert jobs.month_row_count(spark, other, 2019, 7) == 1


def test_dataframes(spark, layout, built):
    assert (built.listens_count, built.users_count, built.recordings_count) == (450, 11, 21)
    stored = jobs.latest_dataframes(spark, layout)
    assert (stored.from_date, stored.to_date, stored.updated) == (datetime(2019, 1, 1), NOW, False)
    counts = read_table(spark, layout.playcounts)
    assert counts.columns == ["user_id", "recording_id", "count"]
    assert built.playcounts_count == counts.count()
    assert counts.agg(F.sum("count")).first()[0] == 450


def test_training_completes_the_metadata(spark, layout, built, trained):
    metadata = read_table(spark, layout.model_metadata)
    assert [f.name for f in metadata.schema] == MODEL_METADATA.fieldNames()
    assert metadata.count() == 2
    latest = jobs.latest_model(spark, layout)
    assert latest.model_id == built.model_id == trained.model_id
    assert latest.updated and latest.listens_count == 450
    assert (latest.from_date, latest.to_date) == (datetime(2019, 1, 1), NOW)
    assert latest.training_data_count + latest.validation_data_count + latest.test_data_count == built.playcounts_count
    assert latest.model_param["rank"] == 2 and latest.model_param.alpha == 3.0
    assert latest.validation_rmse == pytest.approx(trained.validation.rmse) and latest.test_rmse > 0
    assert read_table(spark, layout.model_runs).count() == 2


def test_candidates(spark, layout, with_candidates):
    status = {row.user_name: row.status for row in read_table(spark, layout.user_status).collect()}
    assert len(status) == 11 and set(status.values()) <= {"ok", "similar_artists_are_top_artists"}
    names = read_table(spark, layout.candidate_artists)
    assert names.groupBy("set", "user_id").count().where("count > 4").isEmpty()
    recordings = read_table(spark, layout.recordings)
    for name, path in ((als.TOP_ARTIST_SET, layout.top_artist_set), (als.SIMILAR_ARTIST_SET, layout.similar_artist_set)):
        stored = read_table(spark, path)
        expected = names.where(F.col("set") == name).join(recordings, "artist_name").select("user_id", "recording_id")
        assert stored.exceptAll(expected).isEmpty() and expected.exceptAll(stored).isEmpty() and not stored.isEmpty()
    assert not read_table(spark, layout.similar_artist_report).isEmpty()


def test_recommendations(spark, layout, trained, with_candidates):
    jobs.build_recommendations(spark, layout, CFG)
    playlists = read_table(spark, layout.recommendations)
    assert playlists.columns[:5] == ["user_id", "set", "rank", "recording_id", "rating"]
    status = read_table(spark, layout.recommendation_status)
    assert status.count() == 11
    stored = read_table(spark, layout.top_artist_set).withColumn("set", F.lit(als.TOP_ARTIST_SET)).unionByName(
        read_table(spark, layout.similar_artist_set).withColumn("set", F.lit(als.SIMILAR_ARTIST_SET))
    )
    assert playlists.join(stored, ["user_id", "recording_id", "set"], "left_anti").isEmpty()


def test_only_requested_users(spark, layout, trained, with_candidates):
    requested = spark.createDataFrame([("user 3",), ("nobody",)], "user_name string")
    jobs.build_candidate_sets(spark, layout, NOW, CFG, requested)
    status = dict(read_table(spark, layout.user_status).select("user_name", "status").collect())
    assert set(status) == {"user 3", "nobody"} and status["nobody"] == "unknown_user"
    jobs.build_recommendations(spark, layout, CFG, requested)
    assert read_table(spark, layout.recommendations).select("user_id").distinct().count() == 1
    status = dict(read_table(spark, layout.recommendation_status).select("user_name", "status").collect())
    assert status == {"user 3": "ok", "nobody": "unknown_user"}


def test_user_stats(spark, layout):
    listens = read_table(spark, layout.listens)
    nested = jobs.user_stats_all(listens, NOW, CFG)
    rows = nested.collect()
    assert len(rows) == 11 and sum(e.listen_count for row in rows for e in row.artist_stats) == 450


def test_popularity_export(spark, tmp_path):
    rows = [(NOW, "u", mbid, None, None) for mbid in ["x", "x", "y", None]]
    overwrite(spark.createDataFrame(rows, MBID_LISTEN), str(tmp_path / "in"))
    jobs.export_artist_popularity(spark, str(tmp_path / "in"), str(tmp_path / "csv"), fmt="parquet")
    lines = [l for part in sorted((tmp_path / "csv").glob("part-*")) for l in part.read_text().splitlines()]
    assert lines == ["x,2", "y,1", ",0"]
