import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from turntable.operators import ranking
from turntable.operators.joins import fan_out_join


def skewed(spark, n=5000):
    """Distinct rows of which a third belong to one group, with NULLs and ties."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else rng.choice([None, "", *[f"g{j}" for j in range(40)]])
        rows.append((group, rng.choice([None, *range(50)]), f"{i:05d}"))
    return spark.createDataFrame(rows, "g string, v int, name string").repartition(7)


def test_dense_id_is_row_number(spark, many_tasks):
    rows = skewed(spark)
    numbered = ranking.dense_id(rows, ["g", "v", "name"], "id")
    assert dict(numbered.dtypes)["id"] == "int"
    expected = rows.withColumn("id", F.row_number().over(Window.orderBy("g", "v", "name")))
    assert numbered.exceptAll(expected).isEmpty() and expected.exceptAll(numbered).isEmpty()
    assert ranking.dense_id(rows.limit(0), ["g", "v", "name"], "id").isEmpty()


def test_dense_id_fails_beyond_int(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_MAX_INT", 3)
    with pytest.raises(PySparkException, match="number exceeds 3"):
        ranking.dense_id(spark.range(5), ["id"], "number").collect()


def test_positions_are_row_numbers_per_group(spark, many_tasks):
    rows = skewed(spark)
    order = [F.desc("v"), F.asc("name")]
    placed = ranking.positions(rows, ["g"], order)
    window = Window.partitionBy("g")
    expected = rows.withColumn("position", F.row_number().over(window.orderBy(*order)).cast("bigint")).withColumn(
        "group_size", F.count("*").over(window)
    )
    assert placed.exceptAll(expected).isEmpty() and expected.exceptAll(placed).isEmpty()


def test_positions_sort_a_hot_group_in_several_tasks(spark, many_tasks):
    tagged = ranking._spread_sorted(skewed(spark), ["g", "v", "name"])
    assert tagged.where("g = 'hot'").select("_part").distinct().count() > 1


def test_top_n_breaks_ties_and_keeps_short_groups(spark):
    rows = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x"), ("a", 2, "z"), ("b", 1, "q")], "g string, v int, name string")
    top = ranking.top_n(rows, ["g"], [F.desc("v"), F.asc("name")], 2)
    assert sorted((r.g, r.name, r["rank"]) for r in top.collect()) == [("a", "x", 2), ("a", "z", 1), ("b", "q", 1)]


def test_top_n_beyond_the_group_limit(spark, many_tasks):
    rows = skewed(spark)
    order = [F.desc("v"), F.asc("name")]
    window = Window.partitionBy("g").orderBy(*order)
    expected = rows.withColumn("rank", F.row_number().over(window)).where("rank <= 1200")
    top = ranking.top_n(rows, ["g"], order, 1200)
    assert top.dtypes == expected.dtypes
    assert top.exceptAll(expected).isEmpty() and expected.exceptAll(top).isEmpty()


@pytest.mark.parametrize("left_hot, right_hot", [(900, 500), (5, 3000), (3000, 2), (0, 0)])
def test_fan_out_join_is_the_join(spark, many_tasks, left_hot, right_hot):
    def side(hot, column, keys):
        key = F.when(F.col("id") < hot, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % keys))
        key = F.when(F.col("id") % 97 == 96, F.lit(None)).otherwise(key)
        return spark.range(hot + 300).select(key.alias("k"), F.col("id").alias(column))

    left, right = side(left_hot, "u", 40), side(right_hot, "v", 50)
    joined, expected = fan_out_join(left, right, "k", pairs_per_cell=500), left.join(right, "k")
    assert joined.columns == ["k", "u", "v"]
    assert joined.count() == expected.count()
    assert joined.exceptAll(expected).isEmpty()
    if left_hot > 100 and right_hot > 1:
        tasks = joined.where("k = 'hot'").groupBy(F.spark_partition_id()).count()
        assert tasks.count() > 4
        largest = tasks.agg(F.max("count")).first()[0]
        assert largest < 0.5 * left_hot * right_hot
