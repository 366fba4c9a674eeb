"""Heavy keys by a sketch against plain counts."""

from __future__ import annotations

import collections

import pytest
from pyspark.sql import functions as F

from nestdoc.operators import heavy as H


def plan_of(df):
    return df._jdf.queryExecution().toString()


def exact(df, keys, most, nulls=True):
    rows = collections.Counter(tuple(r) for r in df.select(*keys).collect())
    return {k: n for k, n in rows.items() if n > most and (nulls or None not in k)}


def found(out, keys):
    return {} if out is None else {tuple(r[k] for k in keys): r[H.COUNT] for r in out.collect()}


@pytest.mark.parametrize("tracked", [8, 64, H.TRACKED])
@pytest.mark.parametrize("most", [1, 30, 400, 5000])
def test_like_plain_counts(spark, tracked, most):
    df = spark.range(0, 6000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 97).alias("k"),
        F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("a.b"),
    )
    for keys in (["k"], ["`a.b`"], ["k", "`a.b`"]):
        names = [k.strip("`") for k in keys]
        for nulls in (True, False):
            assert found(H.heavy_keys(df, names, most, nulls=nulls, tracked=tracked), names) == exact(df, keys, most, nulls)


def test_no_heavy_key_moves_no_key(spark):
    df = spark.range(0, 200_000, 1, 8).select((F.col("id") % 50_000).alias("k"))
    one = H.sketch([(df, ["k"])], 1000)[0]
    assert one.rows == 200_000 and one.sure and one.candidates == () and 4 <= one.most < 1000
    assert H.heavy_keys(df, ["k"], 1000, sketched=one) is None
    # candidates alone are counted: the filter stands below the aggregation
    hot = df.select(F.when(F.col("k") % 4 == 0, 7).otherwise(F.col("k")).alias("k"))
    out = H.heavy_keys(hot, ["k"], 1000)
    assert found(out, ["k"]) == {(7,): 50_004}
    assert "xxhash64" in plan_of(out)


def test_many_tables_in_one_job(spark):
    a = spark.range(0, 100, 1, 3).select(F.lit(1).alias("k"))
    b = spark.range(0, 50, 1, 3).select(F.col("id").alias("x"))
    none = b.limit(0)
    got = H.sketch([(a, ["k"]), (b, ["x"]), (none, ["x"])], 10)
    assert [s.rows for s in got] == [100, 50, 0]
    assert [len(s.candidates) for s in got] == [1, 0, 0]
    assert H.heavy_keys(none, ["x"], 10) is None


def test_many_candidates_are_sent_as_a_table(spark):
    df = spark.range(0, 9000, 1, 4).select((F.col("id") % 300).alias("k"))
    assert len(found(H.heavy_keys(df, ["k"], 29), ["k"])) == 300
    assert H.heavy_keys(df, ["k"], 30) is None


def test_few_slots_fall_back_to_plain_counts(spark):
    df = spark.range(0, 5000, 1, 4).select((F.col("id") % 100).alias("k"))
    one = H.sketch([(df, ["k"])], 20, tracked=8)[0]
    assert not one.sure
    assert len(found(H.heavy_keys(df, ["k"], 20, tracked=8), ["k"])) == 100
