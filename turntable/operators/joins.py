"""A join for keys whose output is far larger than their input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turntable.sources.tables import materialise


def fan_out_join(left: DataFrame, right: DataFrame, key: str, pairs_per_cell: int = 1_000_000) -> DataFrame:
    """Inner join on `key` that splits a hot key by the size of its output.

    A key with l rows left and r rows right yields l * r pairs, which the sizes of the shuffled
    inputs do not show, so adaptive skew handling misses it. The pairs of a hot key are cut into
    a grid: left rows are dealt over its rows, right rows over its columns, and each is copied
    along the other axis. Every pair still meets in exactly one cell, and no cell holds many
    rows of either side.

    Each side is read twice; pass tables or materialised frames, not long plans. Each side needs
    a column besides the key, under a name of its own.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = materialise(
        left.groupBy(key)
        .agg(F.count("*").cast("double").alias("_l"))
        .join(right.groupBy(key).agg(F.count("*").cast("double").alias("_r")), key)
        .select(key, "_l", "_r", (F.col("_l") * F.col("_r")).alias("_pairs"))
    )
    total, most = pairs.agg(F.sum("_pairs"), F.max("_pairs")).first()
    # Fewer than 4 * partitions keys can be above such a share, which bounds the broadcasts below.
    share = max(float(pairs_per_cell), (total or 0.0) / (4 * partitions))
    # An explicit count keeps the tasks: by their input bytes alone they would be coalesced.
    if (most or 0.0) <= share:
        return left.repartition(partitions, key).join(right.repartition(partitions, key), key)

    smaller, larger = F.least("_l", "_r"), F.greatest("_l", "_r")
    smaller_cuts = F.ceil(smaller / share**0.5)
    larger_cuts = F.ceil(larger * (smaller / smaller_cuts) / share)
    left_is_smaller = F.col("_l") <= F.col("_r")
    cuts = pairs.where(F.col("_pairs") > share).select(
        key,
        F.when(left_is_smaller, smaller_cuts).otherwise(larger_cuts).alias("_left_cuts"),
        F.when(left_is_smaller, larger_cuts).otherwise(smaller_cuts).alias("_right_cuts"),
    )

    def gridded(side: DataFrame, own: str, other: str) -> DataFrame:
        columns = [F.col(name) for name in side.columns if name != key]
        dealt = F.pmod(F.xxhash64(*columns), F.coalesce(f"{own}_cuts", F.lit(1)))
        copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(f"{other}_cuts", F.lit(1)) - 1)
        return (
            side.join(F.broadcast(cuts), key, "left")
            .withColumn(own, dealt)
            .withColumn(other, F.explode(copies))
            .drop("_left_cuts", "_right_cuts")
            .repartition(partitions, key, "_left", "_right")
        )

    cell = [key, "_left", "_right"]
    return gridded(left, "_left", "_right").join(gridded(right, "_right", "_left"), cell).drop("_left", "_right")
