from __future__ import annotations

import collections

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType

from nestdoc import nest, unnest
from nestdoc.operators.nest import PAGE

from .fixtures import tables


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_nest_struct_fields_and_sorting(spark):
    lists = nest(tables(spark)["payments"], "idsiniestro", "datos_pago")
    assert lists.columns == ["idsiniestro", "datos_pago"]
    fields = [f.name for f in lists.schema["datos_pago"].dataType.elementType.fields]
    assert fields == ["idpago", "estado", "fecha_pago", "importe_pago", "tipo_pago"]
    got = {r.idsiniestro: [p.idpago for p in r.datos_pago] for r in lists.collect()}
    assert got == {10: [100, 101], 11: [102], 99: [103]}


def test_nest_null_key_forms_its_own_group(spark):
    lists = nest(tables(spark)["claims"], "idpoliza", "datos_sin")
    got = {r.idpoliza: sorted(c.idsiniestro for c in r.datos_sin) for r in lists.collect()}
    assert got == {1: [10, 11], 3: [12], None: [13]}


def test_nest_keeps_duplicates(spark):
    lists = nest(tables(spark)["receipts"], "idpoliza", "datos_recibos")
    got = {r.idpoliza: [x.idrecibo for x in r.datos_recibos] for r in lists.collect()}
    assert got[3] == [1001, 1001]


def _sample(spark):
    rows = [(k % 4 if k % 9 else None, f"v{k % 5}", k % 3) for k in range(60)]
    rows += rows[:7]  # true duplicates
    return spark.createDataFrame(rows, "k int, s string, n int")


def test_unnest_of_nest_is_the_input_as_a_bag(spark):
    df = _sample(spark)
    back = unnest(nest(df, "k", "items"), "items", outer=False)
    assert back.columns == ["k", "s", "n"]
    assert bag(back) == bag(df)


def test_nest_result_does_not_depend_on_partitioning_or_order(spark):
    df = _sample(spark)
    a = nest(df.repartition(1), "k", "items").collect()
    b = nest(df.orderBy(F.desc("n"), "s").repartition(7), "k", "items").collect()
    norm = lambda rows: sorted(((r.k is None, r.k), [tuple(x) for x in r["items"]]) for r in rows)
    assert norm(a) == norm(b)
    c = nest(df, "k", "items", shuffle_first=False).collect()
    assert norm(a) == norm(c)


def test_nest_order_by_with_unorderable_field(spark):
    schema = StructType(
        [StructField("k", IntegerType()), StructField("o", IntegerType()), StructField("m", MapType(StringType(), StringType()))]
    )
    df = spark.createDataFrame([(1, 3, {"a": "x"}), (1, 1, {"b": "y"}), (1, 2, None)], schema)
    with pytest.raises(Exception):
        nest(df, "k", "items").collect()
    row = nest(df, "k", "items", order_by=["o"]).collect()[0]
    assert [x.o for x in row["items"]] == [1, 2, 3]


def test_nest_unsorted_still_complete(spark):
    df = _sample(spark)
    back = unnest(nest(df, "k", "items", sort=False), "items", outer=False)
    assert bag(back) == bag(df)


def test_nest_paged_bounds_every_list(spark):
    heavy = [(1, f"x{i:03d}", i) for i in range(50)]
    light = [(2, "a", 1), (2, "b", 2), (None, "z", 0)]
    df = spark.createDataFrame(heavy + light, "k int, s string, n int")
    pages = nest(df, "k", "items", max_items=4)
    assert pages.columns == ["k", PAGE, "items"]
    rows = pages.collect()
    assert all(len(r["items"]) <= 4 for r in rows)
    by_key = collections.defaultdict(list)
    for r in rows:
        by_key[r.k].append(r[PAGE])
    assert sorted(by_key[1]) == list(range(len(by_key[1])))
    assert by_key[2] == [0] and by_key[None] == [0]
    back = unnest(pages.drop(PAGE), "items", outer=False)
    assert bag(back) == bag(df)


def test_nest_paged_rejects_zero(spark):
    with pytest.raises(ValueError):
        nest(_sample(spark), "k", "items", max_items=0)


def test_unnest_outer_keeps_null_lists(spark):
    df = spark.createDataFrame([(1, None)], "k int, items array<struct<a:int>>")
    assert unnest(df, "items").collect()[0].asDict() == {"k": 1, "a": None}
    assert unnest(df, "items", outer=False).count() == 0


def test_nest_paged_splits_a_heavy_null_key(spark):
    rows = [(None, f"n{i:02d}") for i in range(30)] + [(1, "a"), (1, "b")]
    df = spark.createDataFrame(rows, "k int, s string")
    pages = nest(df, "k", "items", max_items=5, checkpoint=False).collect()
    null_pages = [r for r in pages if r.k is None]
    assert len(null_pages) >= 6 and all(len(r["items"]) <= 5 for r in null_pages)
    assert sorted(r[PAGE] for r in null_pages) == list(range(len(null_pages)))
    assert sorted(x.s for r in null_pages for x in r["items"]) == sorted(s for k, s in rows if k is None)


def test_nest_paged_with_known_counts(spark):
    df = _sample(spark)
    light = nest(df, "k", "items", max_items=10_000, heavy_keys=0)
    assert light.columns == ["k", PAGE, "items"]
    assert {r[PAGE] for r in light.collect()} == {0}
    counted = nest(df, "k", "items", max_items=3, key_counts_from=df.select("k"))
    assert bag(unnest(counted.drop(PAGE), "items", outer=False)) == bag(df)


def test_nest_paged_spreads_identical_copies(spark):
    copies = [(1, "same", 7)] * 40 + [(2, "x", 1)]
    df = spark.createDataFrame(copies, "k int, s string, n int").repartition(4)
    pages = nest(df, "k", "items", max_items=6).collect()
    heavy = sorted(r[PAGE] for r in pages if r.k == 1)
    assert heavy == list(range(7))  # 40 copies -> pages 0..6, dense
    assert all(len(r["items"]) <= 6 for r in pages)
    assert sum(len(r["items"]) for r in pages if r.k == 1) == 40


def test_hot_key_broadcast_needs_row_and_byte_budgets(spark, monkeypatch):
    """The heavy-key table is broadcast only under both budgets; fixed-width
    keys with a known count need no measuring job, text keys are measured."""
    import contextlib
    import importlib
    import io

    N = importlib.import_module("nestdoc.operators.nest")  # the package exports the function by that name

    df = spark.createDataFrame([("k" * 50, i) for i in range(6)] + [("b", 1)], "k string, v int")

    def broadcast_hinted(side):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            side.explain(extended=True)
        return "broadcast" in out.getvalue().lower()

    hot, n = N._hot_keys(df.select("k"), ["k"], 3)
    assert n == 1 and broadcast_hinted(hot)
    hot, n = N._hot_keys(df.select("k"), ["k"], 3, known=1)  # text key: measured
    assert n == 1 and broadcast_hinted(hot)
    monkeypatch.setattr(N, "HOT_KEYS_BROADCAST_BYTES", 100)  # 2 x 56 bytes of JSON
    hot, n = N._hot_keys(df.select("k"), ["k"], 3)
    assert n == 1 and not broadcast_hinted(hot)
    ints = df.selectExpr("length(k) AS k")
    hot, n = N._hot_keys(ints, ["k"], 3, known=1)  # fixed width: 48 bytes, no job
    assert n == 1 and broadcast_hinted(hot)
    monkeypatch.setattr(N, "HOT_KEYS_BROADCAST_LIMIT", 0)
    hot, n = N._hot_keys(ints, ["k"], 3, known=1)
    assert not broadcast_hinted(hot)
    # the pages are the same either way
    pages = nest(df, "k", "items", max_items=3, checkpoint=False)
    assert bag(unnest(pages.drop(PAGE), "items", outer=False)) == bag(df)


@pytest.mark.parametrize("max_items", [1, 3, 4])
def test_ordered_pages_follow_the_sort_order(spark, max_items):
    """With ordered_pages, concatenating a key's pages in page order gives
    its whole sorted list (nulls first), heavy keys, copies and nulls included."""
    rows = (
        [(1, i % 5, f"s{i % 3}") for i in range(17)]
        + [(1, None, "z"), (1, 2, None), (2, 7, "a"), (None, 1, "n"), (None, 1, "n"), (None, 0, None)]
        + [(3, 9, "c")] * 9
    )
    df = spark.createDataFrame(rows, "k int, a int, s string").repartition(4)
    pages = nest(df, "k", "items", max_items=max_items, ordered_pages=True).collect()
    got = collections.defaultdict(list)
    for r in sorted(pages, key=lambda r: (r.k is None, r.k or 0, r[PAGE])):
        assert len(r["items"]) <= max_items
        got[r.k] += [(x.a, x.s) for x in r["items"]]

    def nulls_first(t):
        return tuple((v is not None, v) for v in t)

    want = collections.defaultdict(list)
    for k, a, s in rows:
        want[k].append((a, s))
    assert dict(got) == {k: sorted(v, key=nulls_first) for k, v in want.items()}


def test_ordered_pages_give_positions_in_the_whole_list(spark):
    """Payments of sf0.001 (a Parquet scan, paged without checkpoint) in pages
    of 2: page * 2 + place in page equals the row number over the whole key."""
    from pyspark.sql import Window

    from nestdoc.sources import standin

    payments = standin.load_roles(spark, "/root/testdata/sf0.001")["payments"]
    lists = nest(
        payments, "idsiniestro", "datos_pago", max_items=2, ordered_pages=True,
        key_counts_from=payments.select("idsiniestro"), checkpoint=False,
    )
    out = unnest(lists, "datos_pago", outer=False, position="pos")
    got = out.withColumn("pos", F.col(PAGE) * 2 + F.col("pos")).drop(PAGE)
    fields = [c for c in payments.columns if c != "idsiniestro"]
    w = Window.partitionBy("idsiniestro").orderBy(*fields)
    want = payments.select("idsiniestro", (F.row_number().over(w) - 1).alias("pos"), *fields)
    assert got.columns == want.columns
    assert bag(got) == bag(want)


@pytest.mark.parametrize("conf", [None, ("spark.sql.exchange.reuse", "false"), ("spark.sql.adaptive.enabled", "false")])
@pytest.mark.parametrize("key", ["k", "constant"])
def test_ordered_pages_keep_every_row_in_order(spark, conf, key):
    """Pages follow order_by, then the other fields, are dense and hold the bound: whatever the
    plan does with the range sort."""
    before = conf and spark.conf.get(conf[0])
    if conf:
        spark.conf.set(*conf)
    try:
        df = spark.range(0, 6000, 1, 7).select(
            (F.col("id") % 3).alias("k"), F.lit(1).alias("constant"), (F.col("id") * 7919 % 100).alias("price"), "id"
        )
        df = df.select(key, "price", "id")
        rows = nest(df, key, "items", max_items=70, ordered_pages=True, order_by=["price"]).collect()
    finally:
        if conf:
            spark.conf.set(conf[0], before)
    by_key = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[key], r[PAGE])):
        assert len(r["items"]) <= 70 and r[PAGE] == len(by_key[r[key]]) // 70
        by_key[r[key]] += [(i["price"], i["id"]) for i in r["items"]]
    assert sum(map(len, by_key.values())) == 6000
    assert all(items == sorted(items) for items in by_key.values())
