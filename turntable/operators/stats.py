"""Per-user listening statistics and overall popularity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turntable.operators.ranking import positions
from turntable.sources.tables import materialise

ARTIST_COLUMNS = ("artist_name", "artist_msid", "artist_mbids")
RELEASE_COLUMNS = ("release_name", "release_msid", "release_mbid", *ARTIST_COLUMNS)
RECORDING_COLUMNS = (
    "track_name",
    "recording_msid",
    "recording_mbid",
    *ARTIST_COLUMNS,
    "release_name",
    "release_msid",
    "release_mbid",
)


def _listen_counts(listens: DataFrame, entry: Sequence[str], counted: str) -> DataFrame:
    return listens.groupBy("user_name", *entry).agg(F.count(counted).alias("listen_count"))


def user_artists(listens: DataFrame) -> DataFrame:
    """Listens per user and artist."""
    return _listen_counts(listens, ARTIST_COLUMNS, "artist_name")


def user_recordings(listens: DataFrame) -> DataFrame:
    """Listens per user and recording."""
    return _listen_counts(listens, RECORDING_COLUMNS, "recording_msid")


def user_releases(listens: DataFrame) -> DataFrame:
    """Listens per user and release; a release without msid counts 0, one with a blank msid counts."""
    return _listen_counts(listens, RELEASE_COLUMNS, "release_msid")


def monthly_artists(listens: DataFrame) -> DataFrame:
    """Listens per month, user and artist: partial counts that add up to those of any window of months."""
    return listens.groupBy("year", "month", "user_name", *ARTIST_COLUMNS).agg(F.count("artist_name").alias("listen_count"))


def merged_artists(partial: DataFrame) -> DataFrame:
    """`user_artists` from partial counts."""
    return partial.groupBy("user_name", *ARTIST_COLUMNS).agg(F.sum("listen_count").alias("listen_count"))


# Entries of one user up to which a task makes all pages of the list, as it makes a page of the default size.
_ONE_TASK = 10_000


def nest_by_user(counts: DataFrame, entries: str, size: str, page_size: int = 10_000) -> DataFrame:
    """One list of entries per user, most listened first, with the number of the user's entries.

    A list longer than `page_size` continues on the user's next page, so no row and no task
    holds an unbounded list; other users have page 0 only. A list that one task can hold is cut into
    its pages there; only a longer one is sorted over many tasks. `counts` comes from `user_artists`,
    `user_recordings` or `user_releases`. Ties are ordered by the entry's columns.
    """
    most = max(page_size, _ONE_TASK)
    counts = materialise(counts)
    sizes = counts.groupBy("user_name").agg(F.count("*").alias("_size"))
    long_lists = materialise(sizes.where(F.col("_size") > most).select(F.col("user_name").alias("_user")))
    columns = [name for name in counts.columns if name not in ("user_name", "listen_count")]

    def one_list(*sort_key: Column) -> Column:
        # Each column once: the sort key is made of the entry, whose count leads with its sign changed.
        placed = F.sort_array(F.collect_list(F.struct(*sort_key, (-F.col("listen_count")).alias("_less"), *columns)))
        entry = lambda item: F.struct(*[item[name].alias(name) for name in columns], (-item["_less"]).alias("listen_count"))
        return F.transform(placed, entry).alias(entries)

    def whole(rows: DataFrame) -> DataFrame:
        lists = rows.groupBy("user_name").agg(one_list(), F.count("*").alias(size))
        if page_size >= most:
            return lists.select("user_name", F.lit(0).alias("page"), entries, size)
        last = F.floor((F.col(size) - 1) / page_size).cast("int")
        paged = lists.withColumn("page", F.explode(F.sequence(F.lit(0), last)))
        return paged.select("user_name", "page", F.slice(entries, F.col("page") * page_size + 1, page_size).alias(entries), size)

    if long_lists.isEmpty():
        return whole(counts)
    is_long = F.col("user_name").eqNullSafe(F.col("_user"))
    order = [F.desc("listen_count"), *[F.asc(name) for name in columns]]
    placed = positions(counts.join(long_lists, is_long, "left_semi"), ["user_name"], order, size=size)
    page = F.floor((F.col("position") - 1) / page_size).cast("int").alias("page")
    paged = placed.groupBy("user_name", page).agg(one_list(F.col("position")), F.first(size).alias(size))
    return whole(counts.join(long_lists, is_long, "left_anti")).unionByName(paged)


def user_artist_summary(listens: DataFrame) -> DataFrame:
    """Number of artist entries and of listens per user."""
    return (
        user_artists(listens)
        .groupBy("user_name")
        .agg(F.count("*").alias("artist_count"), F.sum("listen_count").alias("total_listens"))
    )


def artist_popularity(listens: DataFrame) -> DataFrame:
    """Listens per artist mbid, most listened first; the NULL artist is kept with 0.

    The mbid in the sort keeps the many artists of equal count from sharing one range.
    """
    return (
        listens.groupBy("artist_mbid")
        .agg(F.count("artist_mbid").alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc("artist_mbid"))
    )
