"""User and recording dimensions with integer ids, and the play counts between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turntable.operators.joins import fan_out_join
from turntable.operators.ranking import dense_id
from turntable.sources.tables import materialise

RECORDING_KEYS = ["track_name", "recording_msid", "artist_name", "artist_msid", "release_name", "release_msid"]

# Metadata variants of one msid or mbid up to which its play counts are joined without splitting.
_MANY_VARIANTS = 100


USER_KEYS = ["user_name"]


def users_dim(listens: DataFrame) -> DataFrame:
    """Distinct users, numbered in name order."""
    return dense_id(listens.select(*USER_KEYS).distinct(), USER_KEYS, "user_id")


def recordings_dim(listens: DataFrame) -> DataFrame:
    """Distinct recordings by their descriptive columns, numbered in the order of those columns."""
    return dense_id(listens.select(*RECORDING_KEYS).distinct(), RECORDING_KEYS, "recording_id")


def kept_ids(rows: DataFrame, keys: list[str], id_column: str, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per key of `rows`, with the ids that `known` has for these keys, and ids above all of these for new ones.

    Returns the numbered rows and, of these, the keys and ids that `known` does not have. New keys are numbered in key
    order; NULL is a key like any other. An id once given stays, so a saved model fits every later build.

    Rows and known keys meet in one aggregation, so `rows` may repeat a key and need not be made distinct by a shuffle
    of their own. Columns beside the keys are those of any row of the key.
    """
    others = [name for name in rows.columns if name not in keys]
    asked = rows.select(*keys, *others, F.lit(None).cast(known.schema[id_column].dataType).alias(id_column), F.lit(True).alias("_asked"))
    nothing = [F.lit(None).cast(rows.schema[name].dataType).alias(name) for name in others]
    have = known.select(*keys, *nothing, id_column, F.lit(False).alias("_asked"))
    met = asked.union(have).groupBy(*keys).agg(
        *[F.any_value(name, F.lit(True)).alias(name) for name in others],
        F.max(id_column).alias(id_column),
        F.bool_or("_asked").alias("_asked"),
    )
    found = materialise(met.where("_asked").select(*rows.columns, id_column))
    new = found.where(F.col(id_column).isNull()).drop(id_column)
    highest = known.agg(F.max(id_column)).first()[0] or 0
    # Reads what dense_id has stored, so it is not written again.
    numbered = dense_id(new, keys, id_column, first=highest + 1).select(*found.columns)
    return found.where(F.col(id_column).isNotNull()).unionByName(numbered), numbered.select(*keys, id_column)


def user_ids(names: DataFrame, users: DataFrame) -> DataFrame:
    """Ids of the requested `user_name`s that exist."""
    return names.select("user_name").distinct().join(users.select("user_name", "user_id"), "user_name")


def with_user_id(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Add `user_id` to rows with a `user_name`; rows of unknown users are dropped."""
    return rows.join(users.select("user_name", "user_id"), "user_name")


def unknown_users(names: DataFrame, users: DataFrame) -> DataFrame:
    """Requested `user_name`s that do not exist."""
    return names.select("user_name").distinct().join(users, "user_name", "left_anti")


def playcounts(listens: DataFrame, users: DataFrame, recordings: DataFrame) -> DataFrame:
    """Listens per user id and recording id.

    A recording_msid with several metadata variants counts under each of them. Listens are
    counted per name and msid before the joins, which then move one row per pair. As ids
    identify the dimension rows, each joined row is final and nothing is aggregated again.

    The joins look up one row per pair, or a few, which adaptive execution splits when a name or
    msid is hot. Should an msid have very many variants, its output is split by size instead.
    """
    counted = (
        listens.where(F.col("user_name").isNotNull() & F.col("recording_msid").isNotNull())
        .groupBy("user_name", "recording_msid")
        .agg(F.count("*").alias("count"))
    )
    named = counted.join(users.select("user_name", "user_id"), "user_name").drop("user_name")
    joined = _with_variants(named, recordings.select("recording_msid", "recording_id"), "recording_msid")
    return joined.select("user_id", "recording_id", "count")


def mbid_recordings_dim(listens: DataFrame) -> DataFrame:
    """Distinct recordings by mbid and track name, numbered in that order."""
    keys = ["recording_mbid", "track_name"]
    return dense_id(listens.select(*keys).distinct(), keys, "recording_id")


def playcounts_by_mbid(listens: DataFrame, users: DataFrame, recordings: DataFrame) -> DataFrame:
    """Listens per user id and recording id, matched by recording mbid; sorted by user and count.

    An mbid with several track names counts under each, like an msid with several variants in `playcounts`.
    """
    counted = (
        listens.where(F.col("user_name").isNotNull() & F.col("recording_mbid").isNotNull())
        .groupBy("user_name", "recording_mbid")
        .agg(F.count("*").alias("play_count"))
    )
    named = counted.join(users.select("user_name", "user_id"), "user_name").drop("user_name")
    joined = _with_variants(named, recordings.select("recording_mbid", "recording_id"), "recording_mbid")
    return joined.select("play_count", "user_id", "recording_id").orderBy("user_id", F.desc("play_count"), "recording_id")


def _with_variants(counts: DataFrame, variants: DataFrame, key: str) -> DataFrame:
    """Counts joined with all variants of their recording; with very many of one, its output is split by size."""
    most = variants.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if most > _MANY_VARIANTS:
        return fan_out_join(materialise(counts), variants, key)
    return counts.join(variants, key)


def playcount_audit(
    counts: DataFrame, users: DataFrame, recordings: DataFrame, user_name: str | None = None
) -> DataFrame:
    """Play counts with their names, most played first; of one user if named."""
    if user_name is not None:
        users = users.where(F.col("user_name") == user_name)
    return (
        counts.join(users.select("user_id", "user_name"), "user_id")
        .join(recordings.select("recording_id", "track_name"), "recording_id")
        .select("play_count", "user_name", "user_id", "recording_id", "track_name")
        .orderBy(F.desc("play_count"), "user_id", "recording_id")
    )
