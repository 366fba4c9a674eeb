"""Lists that one task can gather are cut into pages in place, just as the page plan cuts them."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from nestdoc import BuildOptions, build
from nestdoc.operators.nest import PAGE, cut_pages
from nestdoc.plans import insurance as I
from nestdoc.plans import spec as S

from .fixtures import tables


def made(spark):
    """The hand-made tables, with more claims, payments, receipts and accounts, copies and nulls among them."""
    t = dict(tables(spark))
    for name, row, n in (("payments", "idpago", 9), ("receipts", "idrecibo", 7), ("accounts", "idcuenta", 5)):
        more = t[name].crossJoin(spark.range(n)).withColumn(row, (F.col("id") % 4 + 1000).cast("int")).drop("id")
        t[name] = t[name].unionByName(more)
    t["claims"] = t["claims"].unionByName(t["claims"]).unionByName(t["claims"].withColumn("estado", F.lit(None).cast("string")))
    return t


def rows(df):
    return sorted(map(str, df.collect()))


def test_cut_lists_are_the_pages_of_the_page_plan(spark):
    t, max_items = made(spark), 3
    sorted_over_tasks = build(I.POLICY, t, BuildOptions(max_items=max_items, gather_items=0))
    want = rows(sorted_over_tasks)
    assert any(r[PAGE] > 1 for r in sorted_over_tasks.collect())
    assert rows(build(I.POLICY, t, BuildOptions(max_items=max_items))) == want
    # keys too heavy for one task beside keys that are cut
    assert rows(build(I.POLICY, t, BuildOptions(max_items=max_items, gather_items=10))) == want


def test_many_small_pages_cost_no_checkpoint_and_no_exchange(spark, monkeypatch):
    t = made(spark)
    saved = []
    frame = type(t["claims"])
    write = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda df, *a, **k: (saved.append(df), write(df, *a, **k))[1])

    def exchanges(df):
        return len(re.findall("Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))

    paged = build(I.POLICY, t, BuildOptions(max_items=4))
    assert not [df for df in saved if df.columns != [df.columns[0], "_n"]]
    assert exchanges(paged) <= exchanges(build(I.POLICY, t))


def test_short_lists_are_not_cut(spark):
    heavy = S._measured(I.POLICY, tables(spark), BuildOptions(max_items=100))
    assert ("datos_recibos",) in heavy.short and ("datos_sin", "datos_pago") in heavy.short


def test_cut_pages_of_two_lists(spark):
    df = spark.createDataFrame(
        [(1, [(i,) for i in range(5)], [(4,), (1,), (9,), (1,)]), (2, None, None), (3, [], [(2,)])],
        "k int, a array<struct<v:int>>, b array<struct<w:int>>",
    )
    got = cut_pages(df, {"a": None, "b": lambda x: x["w"].cast("bigint")}, 3)
    assert got.columns == ["k", PAGE, "a", "b"]
    found = [(r.k, r.page, r.a and [x.v for x in r.a], r.b and [x.w for x in r.b]) for r in got.orderBy("k", PAGE).collect()]
    assert found == [
        (1, 0, [0, 1, 2], [4]), (1, 1, [3, 4], [1, 9]), (1, 2, None, [1]),
        (2, 0, None, None), (3, 0, None, [2]),
    ]
    whole = cut_pages(df, {"a": None, "b": None}, 3, short=["a", "b"])
    assert [(r.k, r.page, len(r.b or [])) for r in whole.orderBy("k").collect()] == [(1, 0, 4), (2, 0, 0), (3, 0, 1)]
    with pytest.raises(ValueError):
        cut_pages(df, {"a": None}, 0)


def test_bounded_claims_shuffle_their_rows_once(spark):
    """The plan of `document_bounded`: no scan of a checkpoint, no exchange by page, pages within the bound."""
    t = made(spark)
    spec = I.POLICY.with_children("datos_sin")
    doc = build(spec, t, BuildOptions(max_items=6))
    plan = doc._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)
    assert "rangepartitioning" not in [kind for kind, _ in exchanges]
    assert not [by for _, by in exchanges if PAGE in by]
    weights = [len(r.datos_sin or []) + sum(len(c.datos_pago or []) for c in r.datos_sin or []) for r in doc.collect()]
    assert 6 < sum(weights) and max(weights) <= 12
    whole = build(spec, t).select(F.size("datos_sin").alias("n")).where("n > 0").agg(F.sum("n")).collect()[0][0]
    assert sum(1 for r in doc.collect() for c in r.datos_sin or [] if c[PAGE] == 0) == whole
