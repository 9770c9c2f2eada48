import json
from datetime import datetime

import pytest

from turntable.config import EngineConfig
from turntable.streaming import requests

LISTENS = (
    "user_name string, artist_name string, artist_msid string, artist_mbids array<string>, listened_at timestamp"
)


@pytest.fixture
def registry(spark):
    rows = [("u1", "A", "a", ["m"]), ("u1", "A", "a", ["m"]), ("u1", "B", "b", None), ("u2", "A", "a", ["m"])]
    listens = spark.createDataFrame([(*row, datetime(2019, 5, 1)) for row in rows], LISTENS)
    known = requests.default_registry(listens, datetime(2019, 6, 1), EngineConfig())

    def broken(asked):
        return listens.crossJoin(asked).selectExpr("result_key", "raise_error('no')")

    return {**known, "broken": requests.Handler((), broken)}


MESSAGES = {
    1: "{}",
    2: '{"query": "no.such.query"}',
    3: '{"query": "stats.user.all"}',
    4: '{"query": "stats.user.all", "params": {}}',
    5: '{"query": "stats.user.artists", "params": {"user_name": "u1"}}',
    6: '{"query": "stats.user.artists", "params": {"user_name": "nobody"}}',
    7: '{"query": "stats.user.artists"}',
    8: '{"query": "broken"}',
    9: "not json",
    10: None,
}
EXPECTED = {
    1: ("bad_request", None),
    2: ("unknown_query", None),
    3: ("ok", 2),
    4: ("ok", 2),
    5: ("ok", 2),
    6: ("ok", 0),
    7: ("failed", None),
    8: ("failed", None),
    9: ("bad_request", None),
    10: ("bad_request", None),
}


def test_every_request_gets_its_outcome(spark, registry, tmp_path):
    out = str(tmp_path / "out")
    frame = spark.createDataFrame(list(MESSAGES.items()), "request_id long, message string")
    responses = {row.request_id: row for row in requests.dispatch(frame, registry, out).collect()}
    assert {key: (row.status, row.result_rows) for key, row in responses.items()} == EXPECTED
    assert responses[3].result_key == responses[4].result_key
    results = requests.read_results(spark, out)
    mine = results.where(results.result_key == responses[3].result_key).collect()
    payloads = {entry["user_name"]: entry for entry in (json.loads(row.payload) for row in mine)}
    assert payloads["u1"]["artist_count"] == 2
    assert payloads["u1"]["artist_stats"] == [
        {"artist_name": "A", "artist_msid": "a", "artist_mbids": ["m"], "listen_count": 2},
        {"artist_name": "B", "artist_msid": "b", "artist_mbids": None, "listen_count": 1},
    ]
    assert results.where(results.result_key == responses[6].result_key).isEmpty()


def test_no_requests(spark, registry, tmp_path):
    frame = spark.createDataFrame([], "request_id long, message string")
    assert requests.dispatch(frame, registry, str(tmp_path / "out")).isEmpty()


def test_stream_of_files(spark, registry, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    (tmp_path / "in").mkdir()

    def run():
        requests.stream_requests(spark, inbox, out, registry, checkpoint).awaitTermination()
        return sorted((row.batch_id, row.status, row.result_rows or 0) for row in requests.read_responses(spark, out).collect())

    (tmp_path / "in" / "1.txt").write_text('{"query": "stats.user.all"}\n{}\n')
    first = run()
    assert first == [(0, "bad_request", 0), (0, "ok", 2)]
    assert run() == first
    (tmp_path / "in" / "2.txt").write_text('{"query": "no.such.query"}\n')
    assert run() == [*first, (1, "unknown_query", 0)]


def test_replayed_batch_replaces_its_output(spark, registry, tmp_path):
    out = str(tmp_path / "out")
    frame = spark.createDataFrame(list(MESSAGES.items()), "request_id string, message string")
    for _ in range(2):
        requests.dispatch(frame, registry, out, batch_id=4)
    assert requests.read_responses(spark, out).count() == len(MESSAGES)
    assert requests.read_results(spark, out).count() == 2 + 2


def test_jobs_do_not_grow_with_the_requests(spark, registry, tmp_path):
    """Many users are answered together; counted by the job ids of the status tracker."""
    tracker = spark.sparkContext.statusTracker()

    def jobs(users, name):
        spark.sparkContext.setJobGroup(name, name)
        try:
            message = '{"query": "stats.user.artists", "params": {"user_name": "u%d"}}'
            frame = spark.createDataFrame([(i, message % i) for i in range(users)], "request_id long, message string")
            found = requests.dispatch(frame, registry, str(tmp_path / name)).collect()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert {row.request_id: row.result_rows for row in found} == {i: {1: 2, 2: 1}.get(i, 0) for i in range(users)}
        return len(tracker.getJobIdsForGroup(name))

    assert jobs(60, "many") <= jobs(3, "few") + 2


def test_tables_and_time_are_fresh_in_each_batch(spark, tmp_path):
    now = [0]
    rows = [("u", "A", "a", ["m"], datetime(2019, 5, 1)), ("u", "B", "b", ["m"], datetime(2019, 5, 2))]
    known = requests.default_registry(
        lambda: spark.createDataFrame(rows[: now[0] + 1], LISTENS), lambda: datetime(2019, 6, 1), EngineConfig()
    )
    frame = spark.createDataFrame([(1, '{"query": "stats.user.artists", "params": {"user_name": "u"}}')], "request_id long, message string")
    for batch in range(2):
        now[0] = batch
        assert requests.dispatch(frame, known, str(tmp_path / "out"), batch).first().result_rows == batch + 1
