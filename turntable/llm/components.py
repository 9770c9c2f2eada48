"""Connected components of a graph that no single task or driver could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turntable.sources.tables import materialise


def _starred(edges: DataFrame, larger: bool) -> DataFrame:
    """One step: neighbours of each node are tied to its smallest neighbour instead.

    Either the larger neighbours, or the smaller ones and the node itself. The smallest is found by
    aggregation and joined back, so a node with very many neighbours is dealt over tasks.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("_least"))
    tied = both.join(least, "a")
    if larger:
        made = tied.where("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    else:
        made = tied.select(F.col("b").alias("a"), F.col("_least").alias("b")).union(
            least.select("a", F.col("_least").alias("b"))
        )
    return made.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Per node of `edges` (a, b): node and component, the smallest node it is connected with.

    Alternates the two steps until every node is tied to its smallest alone; the number of rounds grows with
    the logarithm of the largest component. Each round is stored. No edges give no rows; loops are ignored.
    """
    now = materialise(edges.select("a", "b").where("a <> b"))
    seen = None
    while True:
        now = materialise(_starred(_starred(now, larger=True), larger=False))
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    ends = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = ends.select("component").distinct().select(F.col("component").alias("node"), "component")
    return ends.union(roots)
