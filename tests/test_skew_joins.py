"""Split joins with hot keys, and parts of joins on conditions."""

from __future__ import annotations

import collections

import pytest
from pyspark.sql import functions as F

from nestdoc.operators.joins import PART, Skew, join_split, join_tagged


def sides(spark):
    """Key 7 holds a third of the left rows, 8 half of the right ones, 9 many of both, 5 only left."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 7).when(i % 20 == 1, 9).when(i % 20 == 3, 5).when(i % 31 == 2, None).otherwise(i % 200 + 100)
    left = spark.range(0, 3000, 1, 5).select(key.alias("k"), (i % 50).alias("x"), F.lit("same").alias("c"))
    key = F.when(i % 2 == 0, 8).when(i % 20 == 1, 9).when(i == 3, 7).when(i % 31 == 4, None).otherwise(i % 300 + 100)
    right = spark.range(0, 1200, 1, 4).select(key.alias("k"), (i % 9).alias("y"))
    return left, right


def bag(df):
    return collections.Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


@pytest.mark.parametrize("mode", [2, 3, 4])
@pytest.mark.parametrize("rows", [25, 10_000])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_parts_are_those_of_the_plain_join(spark, mode, rows, adaptive):
    left, right = sides(spark)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for a, b in ((left, right), (right.withColumnRenamed("y", "x"), left.select("k", F.col("x").alias("y")))):
            want = join_tagged(a, b, "k", right_cols="*", mode=mode)
            got = join_tagged(a, b, "k", right_cols="*", mode=mode, skew=Skew(rows))
            assert got.columns == want.columns and bag(got) == bag(want)
            stable = join_tagged(a, b, ["k"], right_cols=["y"], mode=mode, skew=Skew(rows, stable=True))
            assert bag(stable) == bag(want)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("mode", [1, 2, 3, 4, 7])
def test_split_joins_are_those_of_the_plain_join(spark, mode):
    left, right = sides(spark)
    right = right.withColumnRenamed("y", "x")  # a name of both sides
    want = join_split(left, right, ["k"], right_cols="*", mode=mode)
    got = join_split(left, right, ["k"], right_cols="*", mode=mode, skew=Skew(25))
    for w, g in zip([want] if mode in (1, 7) else want, [got] if mode in (1, 7) else got, strict=True):
        assert (w is None) == (g is None)
        if w is not None:
            assert w.columns == g.columns
            assert collections.Counter(map(tuple, w.collect())) == collections.Counter(map(tuple, g.collect()))


def test_no_task_holds_a_hot_key(spark):
    """Rows of each task of the join itself, before adaptive execution could help: a key with a
    third of all rows, copies of one row, is dealt evenly."""
    n, partitions = 12_000, 40
    left = spark.range(0, n, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("k"), F.lit("c").alias("x"))
    right = spark.range(0, 500, 1, 3).select(F.when(F.col("id") == 0, 7).otherwise(F.col("id") + 100).alias("k"), F.col("id").alias("y"))
    conf = {
        "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": str(partitions),
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for skew, even in ((None, False), (Skew(100), True)):
            out = join_tagged(left, right, "k", right_cols="*", mode=3, skew=skew)
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert sum(sizes) == n + 166  # right keys that no left row has
            assert (max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]) == even
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_null_keys_are_not_shuffled(spark):
    left = spark.range(0, 100).select(F.lit(None).cast("bigint").alias("k"), "id")
    right = spark.range(0, 3).select(F.col("id").alias("k"), F.lit("r").alias("y"))
    out = join_tagged(left, right, "k", right_cols="*", mode=3, skew=Skew(10))
    assert collections.Counter(r[PART] for r in out.collect()) == {"left_only": 100, "right_only": 3}


def test_parts_on_conditions(spark):
    a = spark.createDataFrame([(1, 5, "p"), (1, 9, "q"), (2, 5, "r"), (None, 1, "s"), (3, None, "t")], "k int, v int, x string")
    b = spark.createDataFrame([(1, 6, "P"), (1, 2, "Q"), (2, 5, "R"), (4, 1, "S"), (None, 1, "T")], "j int, w int, y string")
    on = [a["k"] == b["j"], a["v"] < b["w"]]
    out = join_tagged(a, b, on, left_cols=["k", "x"], right_cols=["y"], mode=3)
    assert out.columns == [PART, "k", "x", "y"]
    got = sorted(tuple(r) for r in out.select(PART, "x", "y").collect())
    assert collections.Counter(got) == collections.Counter(
        [("matched", "p", "P")] + [("left_only", x, None) for x in "qrst"] + [("right_only", None, y) for y in "QRST"]
    )
    parts = join_split(a, b, on, left_cols=["x"], right_cols=["y"], mode=3)
    for part, df in zip(("matched", "left_only", "right_only"), parts, strict=True):
        assert out.where(F.col(PART) == part).count() == df.count()
    for mode, n in ((2, 5), (4, 5)):
        assert join_tagged(a, b, on, left_cols=["x"], right_cols=["y"], mode=mode).count() == n
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2 and plan.count("Join") == 1
    with pytest.raises(ValueError, match="names"):
        join_tagged(a, b, on, left_cols=["x"], right_cols=["y"], skew=Skew())
