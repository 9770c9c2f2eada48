import pytest
from pyspark.sql import Row

from turntable.operators import stats

BASE = Row(
    "user_name", "artist_name", "artist_msid", "artist_mbids", "track_name", "recording_msid", "recording_mbid",
    "release_name", "release_msid", "release_mbid",
)
SCHEMA = (
    "user_name string, artist_name string, artist_msid string, artist_mbids array<string>, track_name string, "
    "recording_msid string, recording_mbid string, release_name string, release_msid string, release_mbid string"
)


def listen(user, release_msid="1", mbids=("1",), artist="artist1"):
    return BASE(user, artist, "1", None if mbids is None else list(mbids), "test", "1", "1", "test", release_msid, "1")


@pytest.fixture
def three_listens(spark):
    return spark.createDataFrame([listen("user2"), listen("user1"), listen("user1")], SCHEMA)


@pytest.mark.parametrize("count", [stats.user_artists, stats.user_recordings, stats.user_releases])
def test_counts_per_user(three_listens, count):
    rows = {row.user_name: row.listen_count for row in count(three_listens).collect()}
    assert rows == {"user1": 2, "user2": 1}


def test_entries_keep_their_columns(three_listens):
    row = stats.user_artists(three_listens).where("user_name = 'user1'").first()
    assert (row.artist_name, row.artist_msid, row.artist_mbids) == ("artist1", "1", ["1"])
    assert stats.user_recordings(three_listens).columns[1:-1] == list(stats.RECORDING_COLUMNS)
    assert stats.user_releases(three_listens).columns[1:-1] == list(stats.RELEASE_COLUMNS)


def test_release_without_msid_counts_nothing_and_blank_counts(spark):
    rows = spark.createDataFrame([listen("u", None), listen("u", None), listen("u", "")], SCHEMA)
    counts = {row.release_msid: row.listen_count for row in stats.user_releases(rows).collect()}
    assert counts == {None: 0, "": 1}


def test_missing_and_empty_mbids_are_two_groups(spark):
    rows = spark.createDataFrame([listen("u", mbids=None), listen("u", mbids=()), listen("u", mbids=())], SCHEMA)
    counts = {str(row.artist_mbids): row.listen_count for row in stats.user_artists(rows).collect()}
    assert counts == {"None": 1, "[]": 2}


def many_artists(spark):
    rows = []
    for user, artists in (("hot", 47), ("small", 3), (None, 23), ("edge", 10)):
        for i in range(artists):
            rows += [listen(user, artist=f"a{i:02d}")] * (i % 5 + 1)
    return stats.user_artists(spark.createDataFrame(rows, SCHEMA))


def test_long_lists_continue_on_pages(spark, many_tasks):
    counts = many_artists(spark)
    nested = stats.nest_by_user(counts, "artists", "artist_count", page_size=10).collect()
    pages = {(row.user_name, row.page): row for row in nested}
    assert sorted(pages, key=str) == sorted(
        [("hot", i) for i in range(5)] + [("small", 0), ("edge", 0)] + [(None, i) for i in range(3)], key=str
    )
    for user, size in (("hot", 47), ("small", 3), (None, 23), ("edge", 10)):
        mine = [pages[key] for key in sorted((k for k in pages if k[0] == user), key=lambda k: k[1])]
        assert {row.artist_count for row in mine} == {size}
        entries = [(-e.listen_count, e.artist_name) for row in mine for e in row.artists]
        assert len(entries) == size and entries == sorted(entries)
        assert all(len(row.artists) <= 10 for row in mine)


def test_whole_lists_need_no_pages(spark):
    nested = stats.nest_by_user(many_artists(spark), "artists", "artist_count").collect()
    assert {row.user_name: (row.page, len(row.artists), row.artist_count) for row in nested} == {
        "hot": (0, 47, 47), "small": (0, 3, 3), None: (0, 23, 23), "edge": (0, 10, 10),
    }


def test_popularity_keeps_the_unknown_artist_with_zero(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), (None,)], "artist_mbid string")
    ranking = [tuple(row) for row in stats.artist_popularity(rows).collect()]
    assert ranking == [("a", 2), ("b", 1), (None, 0)]


def test_lists_that_a_task_holds_are_cut_there(spark, monkeypatch):
    """Lists longer than a page are sorted over many tasks only if one task cannot hold them; the pages are the same."""
    counts = many_artists(spark).cache()

    def pages():
        nested = stats.nest_by_user(counts, "artists", "artist_count", page_size=10)
        return sorted((tuple(row) for row in nested.collect()), key=str)

    placed, sorted_lists = stats.positions, []
    monkeypatch.setattr(stats, "positions", lambda *args, **named: sorted_lists.append(1) or placed(*args, **named))
    in_tasks = pages()
    assert not sorted_lists
    monkeypatch.setattr(stats, "_ONE_TASK", 20)
    assert pages() == in_tasks and len(sorted_lists) == 1
    monkeypatch.setattr(stats, "_ONE_TASK", 1)
    assert pages() == in_tasks and len(sorted_lists) == 2
