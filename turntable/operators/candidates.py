"""Candidate recordings for all users at once: of their top artists and of similar artists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turntable.operators.joins import fan_out_join
from turntable.operators.ranking import top_n


def top_artists(listens: DataFrame, limit: int) -> DataFrame:
    """The `limit` most listened artists of each user.

    An artist name with several msids takes one place per msid.
    """
    counts = listens.groupBy("user_name", "artist_name", "artist_msid").agg(F.count("artist_msid").alias("count"))
    order = [F.desc("count"), F.asc("artist_name"), F.asc("artist_msid")]
    return top_n(counts, ["user_name"], order, limit)


def undirected(relation: DataFrame) -> DataFrame:
    """Every edge in both directions, without repeats of the same edge and count."""
    # Repeats go while each edge is one row, its lesser name first and NULL last; then it is turned.
    one, other = F.col("artist_name_0"), F.col("artist_name_1")
    turned = F.coalesce(one > other, one.isNull())
    edges = relation.select(
        F.when(turned, other).otherwise(one).alias("_a"), F.when(turned, one).otherwise(other).alias("_b"), "count"
    ).distinct()

    def way(start: str, end: str) -> Column:
        return F.struct(F.col(start).alias("artist_name"), F.col(end).alias("similar_artist_name"))

    ways = F.when(F.col("_a").eqNullSafe(F.col("_b")), F.array(way("_a", "_b"))).otherwise(F.array(way("_a", "_b"), way("_b", "_a")))
    return edges.select(F.explode(ways).alias("_way"), "count").select("_way.*", "count")


def similar_artists(relation: DataFrame, limit: int) -> DataFrame:
    """The `limit` strongest relations of each artist."""
    order = [F.desc("count"), F.asc("similar_artist_name")]
    return top_n(undirected(relation), ["artist_name"], order, limit)


def similar_to_top(top: DataFrame, similar: DataFrame) -> DataFrame:
    """Each user's top artists with their similar artists."""
    return (
        top.select("user_name", "artist_name")
        .distinct()
        .join(similar.select("artist_name", "similar_artist_name"), "artist_name")
        .select("user_name", "artist_name", "similar_artist_name")
    )


def top_artists_with_relation(top: DataFrame, similar: DataFrame) -> DataFrame:
    """Each user's top artists that have any similar artist."""
    return (
        top.select("user_name", "artist_name")
        .distinct()
        .join(similar.select("artist_name"), "artist_name", "left_semi")
        .select("user_name", "artist_name")
    )


def net_similar_artists(top: DataFrame, similar: DataFrame) -> DataFrame:
    """Artists similar to a user's top artists and not among them."""
    reached = similar_to_top(top, similar).select("user_name", F.col("similar_artist_name").alias("artist_name"))
    return reached.where("artist_name IS NOT NULL").distinct().join(
        top.select("user_name", "artist_name"), ["user_name", "artist_name"], "left_anti"
    )


def similar_artist_report(top: DataFrame, similar: DataFrame) -> DataFrame:
    """Each user's top artists with the list of their similar artists, strongest first.

    A list is as long as the limit `similar` was cut to, and is built once per artist.
    """
    ranked = F.sort_array(F.collect_list(F.struct("rank", "similar_artist_name")))
    lists = similar.groupBy("artist_name").agg(ranked.alias("ranked"))
    lists = lists.select("artist_name", F.col("ranked.similar_artist_name").alias("similar_artists"))
    return top.select("user_name", "artist_name").distinct().join(lists, "artist_name").select(
        "user_name", "artist_name", "similar_artists"
    )


def candidate_recordings(artists: DataFrame, recordings: DataFrame) -> DataFrame:
    """All recordings of each user's artists, as (user_id, recording_id).

    Recordings match by artist name. `artists` is a stored table with distinct
    (user_id, artist_name); see `fan_out_join`.
    """
    wanted = artists.select("user_id", "artist_name")
    return fan_out_join(wanted, recordings.select("artist_name", "recording_id"), "artist_name").select(
        "user_id", "recording_id"
    )


def candidates_of_user(candidates: DataFrame, user_id: int) -> DataFrame:
    """One user's candidates."""
    return candidates.where(F.col("user_id") == user_id)


def similar_artists_of(similar: DataFrame, artist_name: str) -> DataFrame:
    """The similar artists of one artist."""
    return similar.where(F.col("artist_name") == artist_name).select("similar_artist_name")


# Why a requested user has no, or only a part of the, candidates.
UNKNOWN_USER = "unknown_user"
NO_LISTENS = "no_listens"
NO_SIMILAR_ARTISTS = "no_similar_artists"
SIMILAR_ARE_TOP = "similar_artists_are_top_artists"
NO_SIMILAR_RECORDINGS = "no_similar_recordings"
COMPLETE = "ok"


def user_status(
    requested: DataFrame,
    users: DataFrame,
    top: DataFrame,
    with_relation: DataFrame,
    net_similar: DataFrame,
    recordings: DataFrame,
) -> DataFrame:
    """What became of each requested `user_name`: complete, or the first step that gave nothing.

    Works on who is present at each step, never on the candidates themselves.
    """
    playable = net_similar.join(recordings.select("artist_name").distinct(), "artist_name", "left_semi")
    steps = [
        (UNKNOWN_USER, users),
        (NO_LISTENS, top),
        (NO_SIMILAR_ARTISTS, with_relation),
        (SIMILAR_ARE_TOP, net_similar),
        (NO_SIMILAR_RECORDINGS, playable),
    ]
    # One bit for each step at which a user is present: one aggregate and one join, however many steps.
    present = [step.select("user_name", F.lit(1 << at).alias("_step")) for at, (_, step) in enumerate(steps)]
    seen = reduce(DataFrame.unionByName, present).groupBy("user_name").agg(F.bit_or("_step").alias("_steps"))
    outcome = F.lit(COMPLETE)
    for at, (reason, _) in reversed(list(enumerate(steps))):
        missing = F.coalesce("_steps", F.lit(0)).bitwiseAND(1 << at) == 0
        outcome = F.when(missing, reason).otherwise(outcome)
    return requested.select("user_name").distinct().join(seen, "user_name", "left").select("user_name", outcome.alias("status"))
