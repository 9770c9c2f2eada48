"""Domain tables derived from the generic test tables (see FIXTURES.md section 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listens_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listen per event: few artists and tracks, many users, one month."""
    k = F.col("k")
    artist, release = (k % 20).cast("string"), (k % 40).cast("string")
    recording_mbid = F.when(F.col("event_type") == "error", F.lit(None).cast("string")).when(
        F.col("event_type") == "signup", F.lit("")
    )
    events = _table(spark, sf_dir, "events").withColumn(
        "k", F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("int")
    )
    return events.select(
        F.when(k % 20 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("mb-"), artist)))
        .alias("artist_mbids"),
        F.concat(F.lit("a-"), artist).alias("artist_msid"),
        F.concat(F.lit("artist_"), artist).alias("artist_name"),
        F.col("ts").alias("listened_at"),
        recording_mbid.otherwise(F.concat(F.lit("rm-"), k)).alias("recording_mbid"),
        F.concat(F.lit("r-"), k).alias("recording_msid"),
        F.concat(F.lit("relm-"), release).alias("release_mbid"),
        F.when(k % 10 != 0, F.concat(F.lit("rel-"), release)).alias("release_msid"),
        F.concat(F.lit("release_"), release).alias("release_name"),
        F.array("event_type").alias("tags"),
        F.concat(F.lit("track_"), k).alias("track_name"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("user_name"),
    )


def raw_listens_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw submissions as JSON text, one `value` per event, with optional fields left out or null."""
    events = _table(spark, sf_dir, "events").withColumn(
        "k", F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("int")
    )
    epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    text = F.format_string(
        '{"listened_at": %d, "user_name": "user_%d", "recording_msid": "r-%d", "track_metadata": '
        '{"artist_name": "artist_%d", "track_name": "track_%d"%s, "additional_info": {"artist_msid": "a-%d"%s}}}',
        epoch,
        F.col("user_id"),
        F.col("k"),
        F.col("k") % 20,
        F.col("k"),
        F.when(F.col("event_type") == "view", F.lit(', "release_name": null'))
        .when(F.col("event_type") == "error", F.lit(""))
        .otherwise(F.format_string(', "release_name": "release_%d"', F.col("k") % 40)),
        F.col("k") % 20,
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(
            F.format_string(', "artist_mbids": ["mb-%d", "x"], "tags": ["%s"]', F.col("k") % 20, F.col("event_type"))
        ),
    )
    return events.select(text.alias("value"))


def listens_from_orders(spark: SparkSession, sf_dir: str, fan_out: bool = False) -> DataFrame:
    """One listen per order line over many months; artists, tracks and users grow with the data.

    With `fan_out` a recording_msid stands for a part alone, so that it has one metadata variant
    per supplier of the part.
    """
    part, supplier = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    msid = F.concat(F.lit("r-"), part) if fan_out else F.concat(F.lit("r-"), part, F.lit("-"), supplier)
    # Orders get their customers before they meet the lines, which are several times as many and move once less.
    orders = _table(spark, sf_dir, "orders").join(_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = (
        _table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(_table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return lines.select(
        F.array().cast("array<string>").alias("artist_mbids"),
        F.concat(F.lit("a-"), supplier).alias("artist_msid"),
        F.col("s_name").alias("artist_name"),
        F.col("o_orderdate").alias("listened_at"),
        F.lit("").alias("recording_mbid"),
        msid.alias("recording_msid"),
        F.lit("").alias("release_mbid"),
        F.col("p_brand").alias("release_msid"),
        F.col("p_brand").alias("release_name"),
        F.array("l_returnflag").alias("tags"),
        F.col("p_name").alias("track_name"),
        F.col("c_name").alias("user_name"),
    )


def relation_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artist relation: how often two artists occur in events with neighbouring ids.

    Every event adds at most one edge, so the work is linear whatever the users' sizes.
    """
    events = _table(spark, sf_dir, "events").select(
        "event_id", (F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("int") % 20).alias("a")
    )
    following = events.select((F.col("event_id") - 1).alias("event_id"), F.col("a").alias("b"))
    names = [F.concat(F.lit("artist_"), F.col(side)) for side in ("a", "b")]
    return (
        events.join(following, "event_id")
        .where("a <> b")
        .groupBy(F.least(*names).alias("artist_name_0"), F.greatest(*names).alias("artist_name_1"))
        .agg(F.count("*").alias("count"))
    )


def relation_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artist relation: how often two suppliers occur on neighbouring lines of an order."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("a"))
    following = lines.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("a").alias("b"))
    suppliers = _table(spark, sf_dir, "supplier")
    counted = (
        lines.join(following, ["l_orderkey", "l_linenumber"])
        .where("a <> b")
        .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .agg(F.count("*").alias("count"))
    )
    return (
        counted.join(suppliers.select(F.col("s_suppkey").alias("a"), F.col("s_name").alias("artist_name_0")), "a")
        .join(suppliers.select(F.col("s_suppkey").alias("b"), F.col("s_name").alias("artist_name_1")), "b")
        .select("artist_name_0", "artist_name_1", "count")
    )


def mbid_listens_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listens of the second data set: string artist mbid, NULL for one artist in twenty."""
    return listens_from_events(spark, sf_dir).select(
        "listened_at",
        "user_name",
        F.try_element_at(F.col("artist_mbids"), F.lit(1)).alias("artist_mbid"),
        "release_mbid",
        "recording_mbid",
    )


def requests_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request message per event; the event type decides what kind of request it is, its user about whom."""
    message = (
        F.when(F.col("event_type") == "view", F.lit('{"query": "stats.user.all"}'))
        .when(
            F.col("event_type") == "purchase",
            F.concat(F.lit('{"query": "stats.user.artists", "params": {"user_name": "user_'), "user_id", F.lit('"}}')),
        )
        .when(F.col("event_type") == "click", F.lit('{"query": "stats.unknown"}'))
        .when(F.col("event_type") == "signup", F.lit('{"query": "stats.user.all", "params": {"bogus": "1"}}'))
        .otherwise(F.lit("{}"))
    )
    return _table(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), message.alias("message"))
