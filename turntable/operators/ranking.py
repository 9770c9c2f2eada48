"""Ranks, dense ids and positions that no single task has to compute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turntable.sources.tables import materialise

_MAX_INT = 2**31 - 1
# monotonically_increasing_id holds the partition above bit 33 and the row's place below it.
_ROW_BITS = 33
_BEFORE = (Window.unboundedPreceding, -1)


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first `n` rows of each group by a total `order`, with their rank from 1.

    Spark cuts every group to `n` rows before the shuffle (WindowGroupLimit), so a hot group
    costs its reducer at most `n` rows per input partition. Where `n` is above what Spark does
    that for, a group is sorted over many tasks instead.
    """
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        placed = positions(df, group, order, rank, "_size").where(F.col(rank) <= n)
        return placed.withColumn(rank, F.col(rank).cast("int")).drop("_size")
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def _spread_sorted(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """`df` range-partitioned and sorted, each row tagged with its partition and place therein.

    Written out once: range bounds are sampled, so a recomputed partition could differ.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    tag = F.monotonically_increasing_id()
    tagged = ranged.withColumn("_tag", tag).select(
        "*",
        F.shiftright("_tag", _ROW_BITS).cast("int").alias("_part"),
        F.col("_tag").bitwiseAND(F.lit(2**_ROW_BITS - 1)).alias("_row"),
    )
    return materialise(tagged.drop("_tag"))


def dense_id(df: DataFrame, keys: Sequence[str], id_column: str, first: int = 1) -> DataFrame:
    """Number the rows of `df` from `first` in the order of `keys`, NULLs first, as an int.

    Equals `row_number() over (order by keys)`, counted on, without its single partition. `keys` must order
    the rows totally. Fails above the largest int, which is what ALS can take as an id.
    """
    tagged = _spread_sorted(df, keys)
    sizes = tagged.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per partition: small enough for one window and for a broadcast at any scale.
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(*_BEFORE))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    number = F.col("_start") + F.col("_row") + first
    too_many = F.raise_error(F.lit(f"{id_column} exceeds {_MAX_INT}"))
    return tagged.join(F.broadcast(starts), "_part").select(
        *df.columns, F.when(number <= _MAX_INT, number).otherwise(too_many).cast("int").alias(id_column)
    )


def positions(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    position: str = "position",
    size: str = "group_size",
) -> DataFrame:
    """Add each row's place in its group by a total `order`, and the group's size.

    Equals `row_number` and `count(*)` over windows by `group`, but a group of any size is
    sorted over as many tasks as it fills ranges: only the runs, one row per group and range,
    meet in a window. NULL is a group of its own.
    """
    tagged = _spread_sorted(df, [*group, *order])
    runs = tagged.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_length"))
    per_group = Window.partitionBy(*group)
    before = F.sum("_length").over(per_group.orderBy("_part").rowsBetween(*_BEFORE))
    # Stored, so that the join knows its size and leaves the wide rows in place when it is small.
    runs = materialise(
        runs.select(
            *[F.col(name).alias(f"_run_{name}") for name in group],
            F.col("_part").alias("_run_part"),
            (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"),
            F.sum("_length").over(per_group).alias(size),
        )
    )
    same_run = F.col("_part") == F.col("_run_part")
    for name in group:
        same_run &= F.col(name).eqNullSafe(F.col(f"_run_{name}"))
    return tagged.join(runs, same_run).select(*df.columns, (F.col("_row") + F.col("_shift")).alias(position), size)
