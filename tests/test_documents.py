from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from nestdoc import BuildOptions, Child, DocSpec, Lookup, build
from nestdoc.operators.nest import PAGE
from nestdoc.plans import insurance as I
from nestdoc.plans.spec import heavy_key_counts

from .fixtures import OPEN, tables


def by_key(df, key="numpoliza"):
    return {r[key]: r for r in df.collect()}


def test_document_rows_and_columns(spark):
    doc = I.policy_document(tables(spark))
    assert doc.columns[:10] == [
        "numpoliza", "pol_estado", "fecha_efecto", "fecha_sol", "fecha_vencimiento", "formapago",
        "fecha_baja", "causa_baja", "fecha_suspension", "causa_suspen",
    ]
    assert doc.columns[10:] == ["datos_sin", "datos_recibos", "datos_tarifa", "datos_cliente"]
    assert sorted(by_key(doc)) == [1, 2, 3]  # 4 has no tariff, 5 no participant


def test_document_field_layout(spark):
    schema = I.policy_document(tables(spark)).schema
    claim = schema["datos_sin"].dataType.elementType
    assert [f.name for f in claim.fields] == [
        "idsiniestro", "fecha_ocurs", "fecha_apertura", "fecha_cierre", "tipo_siniestro", "estado", "datos_pago",
    ]
    assert [f.name for f in claim["datos_pago"].dataType.elementType.fields] == [
        "idpago", "estado", "fecha_pago", "importe_pago", "tipo_pago",
    ]
    client = schema["datos_cliente"].dataType.elementType
    assert [f.name for f in client.fields] == [
        "idcliente", "tipo_intervencio", "estado", "fecha_alta", "fecha_baja", "orden_inter",
        "nombre", "apellidos", "fecnaci", "direccion", "numdni", "datos_cuenta",
    ]
    assert "idcliente" not in [f.name for f in client["datos_cuenta"].dataType.elementType.fields]
    assert [f.name for f in schema["datos_tarifa"].dataType.elementType.fields] == [
        "tarifa", "situacion", "fecha_alta", "fecha_baja", "importe_prima",
    ]


def test_document_values_and_null_cases(spark):
    docs = by_key(I.policy_document(tables(spark)))
    p1, p2, p3 = docs[1], docs[2], docs[3]
    # complete policy
    assert [c.idsiniestro for c in p1.datos_sin] == [10, 11]
    assert [p.idpago for p in p1.datos_sin[0].datos_pago] == [100, 101]
    assert p1.datos_sin[0].datos_pago[1].fecha_pago == OPEN
    assert [r.idrecibo for r in p1.datos_recibos] == [1000]
    assert [t.tarifa for t in p1.datos_tarifa] == ["TF1", "TS1"]
    assert [a.idcuenta for a in p1.datos_cliente[0].datos_cuenta] == [70, 71]
    assert p1.datos_cliente[0].nombre == "Ana"
    # no claim, no receipt: null lists, not empty ones; client without account
    assert p2.datos_sin is None and p2.datos_recibos is None
    assert p2.datos_cliente[0].nombre == "Luis" and p2.datos_cliente[0].datos_cuenta is None
    # claim without payment; two equal receipts kept; participant without client
    assert p3.datos_sin[0].datos_pago is None
    assert [r.idrecibo for r in p3.datos_recibos] == [1001, 1001]
    assert p3.datos_cliente[0].idcliente == 9 and p3.datos_cliente[0].nombre is None


def test_left_options_keep_every_policy(spark):
    doc = I.policy_document(tables(spark), how_tariffs="left", how_participants="left")
    docs = by_key(doc)
    assert sorted(docs) == [1, 2, 3, 4, 5]
    assert docs[4].datos_tarifa is None and docs[5].datos_cliente is None


def test_dropped_policies(spark):
    assert sorted(r.numpoliza for r in I.dropped_policies(tables(spark)).collect()) == [4, 5]


def test_stages(spark):
    t = tables(spark)
    assert sorted((r.idpoliza is None, r.idpoliza) for r in I.claims_with_payments(t).collect()) == [
        (False, 1), (False, 3), (True, None),
    ]
    assert I.receipts_by_policy(t).count() == 3
    assert I.tariffs_by_policy(t).count() == 4
    cwa = by_key(I.clients_with_accounts(t), "idcliente")
    assert len(cwa[7].datos_cuenta) == 2 and cwa[8].datos_cuenta is None
    assert sorted(by_key(I.policy_core(t))) == [1, 2, 3, 5]
    assert sorted(by_key(I.participants_by_policy(t))) == [1, 2, 3, 4]


def test_lookup_name_clash_raises(spark):
    t = tables(spark)
    t["clients"] = t["clients"].withColumnRenamed("nombre", "estado")
    with pytest.raises(ValueError, match="estado"):
        I.policy_document(t)


def test_key_types_are_aligned(spark):
    t = tables(spark)
    t["receipts"] = t["receipts"].withColumn("idpoliza", F.col("idpoliza").cast("bigint"))
    doc = I.policy_document(t)
    assert dict(doc.dtypes)["numpoliza"] == "bigint"
    assert sorted(by_key(doc)) == [1, 2, 3]


def test_generic_spec(spark):
    orders = spark.createDataFrame([(1, 10), (2, 10), (3, 20)], "o int, c int")
    lines = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "o int, item string")
    cust = spark.createDataFrame([(10, "x"), (20, "y"), (30, "z")], "c int, name string")
    seg = spark.createDataFrame([("x", "gold")], "name string, segment string")
    spec = DocSpec(
        "cust", key="c",
        lookups=(Lookup(DocSpec("seg", key="name"), on="name"),),
        children=(Child(DocSpec("orders", key="o", children=(Child(DocSpec("lines"), "o", "lines"),)), "c", "orders"),),
    )
    out = by_key(build(spec, {"orders": orders, "lines": lines, "cust": cust, "seg": seg}), "c")
    assert out[10].segment == "gold" and out[20].segment is None
    assert [(o.o, [x.item for x in (o.lines or [])]) for o in out[10].orders] == [(1, ["a", "b"]), (2, [])]
    assert out[30].orders is None


def test_paged_document_holds_every_item(spark):
    t = tables(spark)
    doc = I.policy_document(t, BuildOptions(max_items=1))
    assert PAGE in doc.columns
    rows = doc.collect()
    for col in ("datos_sin", "datos_recibos", "datos_tarifa", "datos_cliente"):
        assert all(r[col] is None or len(r[col]) <= 1 for r in rows)
    assert sorted({r.numpoliza for r in rows}) == [1, 2, 3]
    n_tariffs = sum(len(r.datos_tarifa or []) for r in rows)
    n_receipts = sum(len(r.datos_recibos or []) for r in rows)
    assert (n_tariffs, n_receipts) == (4, 3)


def test_rename_option_renames_payment_state(spark):
    from dataclasses import replace

    payments = replace(I.PAYMENTS, rename=(("estado", "estado_pago"),))
    claims = replace(I.CLAIMS, children=(replace(I.CLAIMS.children[0], spec=payments),))
    doc = build(claims, tables(spark))
    fields = [f.name for f in doc.schema["datos_pago"].dataType.elementType.fields]
    assert "estado_pago" in fields and "estado" not in fields


def test_checkpointed_lists_give_the_same_document(spark):
    t = tables(spark)
    plain = sorted(map(str, I.policy_document(t).collect()))
    saved = I.policy_document(t, BuildOptions(checkpoint_lists=True))
    assert sorted(map(str, saved.collect())) == plain


def test_children_beside_a_paged_lookup_are_refused(spark):
    t = tables(spark)
    spec = DocSpec(
        "participants", key="numpoliza",
        lookups=(Lookup(I.CLIENTS, on="idcliente"),),
        children=(Child(DocSpec("tariffs"), fk="num_poliza", out="datos_tarifa"),),
    )
    with pytest.raises(ValueError, match="paged"):
        build(spec, t, BuildOptions(max_items=1))
    assert build(spec, t).count() == 4


def test_bounded_broadcast_budgets(spark):
    from nestdoc.plans.spec import bounded_broadcast

    import contextlib
    import io

    df = spark.range(100).selectExpr("id", "repeat('x', 100) AS s")
    big = spark.range(1_000_000).withColumnRenamed("id", "k")

    def hinted(side):
        out = io.StringIO()
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only the hint may broadcast
        try:
            with contextlib.redirect_stdout(out):
                big.join(side, big.k == side.id).explain()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        return "BroadcastHashJoin" in out.getvalue()

    assert hinted(bounded_broadcast(df, 1000, 1 << 20))
    assert not hinted(bounded_broadcast(df, 99, 1 << 20))  # too many rows
    assert not hinted(bounded_broadcast(df, 1000, 10_000))  # too many bytes
    assert not hinted(bounded_broadcast(df, 1000, 1 << 20, base=spark.range(5000)))  # base too large


def test_lookup_fits_measures_the_whole_subtree(spark):
    from nestdoc.plans.spec import lookup_fits

    t = tables(spark)
    assert lookup_fits(I.CLIENTS, t, 1000, 1 << 20)
    assert not lookup_fits(I.CLIENTS, t, 1, 1 << 20)  # accounts has 2 rows
    assert not lookup_fits(I.CLIENTS, t, 1000, 100)  # bytes


@pytest.mark.parametrize("stable", [False, True])
@pytest.mark.parametrize("max_items", [1, 2])
def test_paged_claims_keep_their_own_pages(spark, max_items, stable):
    t = tables(spark)

    def pairs(rows):
        return sorted(
            (r.numpoliza, c.idsiniestro, p.idpago)
            for r in rows for c in (r.datos_sin or []) for p in (c.datos_pago or [])
        )

    plain = I.policy_document(t).collect()
    paged = I.policy_document(t, BuildOptions(max_items=max_items, stable_inputs=stable)).collect()
    assert pairs(paged) == pairs(plain)
    firsts = sorted((r.numpoliza, c.idsiniestro) for r in paged for c in (r.datos_sin or []) if c[PAGE] == 0)
    assert firsts == sorted((r.numpoliza, c.idsiniestro) for r in plain for c in (r.datos_sin or []))


def test_heavy_key_counts_per_child_and_key_type(spark):
    """The pre-pass counts each child on its own key column, whatever its
    type (int, text, null keys included), and reports one number per list."""
    from nestdoc.plans.spec import heavy_key_counts

    parent = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    by_int = spark.createDataFrame([(1,)] * 3 + [(2,)] * 2 + [(None,)] * 4, "pid int")
    by_text = spark.createDataFrame(
        [("x", 1)] * 3 + [("y", 2)] * 3 + [("z", 3)] + [(None, 4)] * 2, "code string, v int"
    )
    grand = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    text_child = Child(
        DocSpec("by_text", key="v", children=(Child(DocSpec("grand"), fk="v", out="gs"),)), fk="code", out="ts"
    )
    int_child = Child(DocSpec("by_int"), fk="pid", out="is")
    spec = DocSpec("parent", key="id", children=(int_child, text_child))
    tables_ = {"parent": parent, "by_int": by_int, "by_text": by_text, "grand": grand}
    got = heavy_key_counts(spec, tables_, max_items=2)
    grand_child = text_child.spec.children[0]
    # pid 1 (3 rows) and the null key (4 rows); codes x and y (3 rows each); no v over 2
    assert got == {id(int_child): 2, id(text_child): 2, id(grand_child): 0}
    assert heavy_key_counts(spec, tables_, max_items=10) == {id(int_child): 0, id(text_child): 0, id(grand_child): 0}


def test_stable_parquet_inputs_page_without_checkpoint(spark):
    """Leaf lists of Parquet scans are paged straight from the files: every
    item is kept and every list stays within the bound, as with the
    checkpointed path."""
    from nestdoc.sources import standin

    roles = standin.load_roles(spark, "/root/testdata/sf0.001")

    def items(doc):
        return sorted(
            (r.numpoliza, "r", x.idrecibo) for r in doc.collect() for x in (r.datos_recibos or [])
        ) + sorted((r.numpoliza, "t", x.tarifa) for r in doc.collect() for x in (r.datos_tarifa or []))

    spec = I.POLICY.with_children("datos_recibos", "datos_tarifa")
    plain = build(spec, roles)
    stable = build(spec, roles, BuildOptions(max_items=3, stable_inputs=True))
    saved = build(spec, roles, BuildOptions(max_items=3))
    assert items(stable) == items(plain) == items(saved)
    for r in stable.collect():
        assert len(r.datos_recibos or []) <= 3 and len(r.datos_tarifa or []) <= 3


def test_pre_pass_counts_lookup_tables_in_the_same_job(spark):
    from nestdoc.plans.spec import heavy_key_counts, lookup_fits

    t = tables(spark)
    rows: dict = {}
    heavy_key_counts(I.POLICY, t, 1_000_000, lookup_rows=rows)
    lk = I.PARTICIPANTS.lookups[0]
    assert rows == {id(lk): [t["clients"].count(), t["accounts"].count()]}
    assert lookup_fits(lk.spec, t, 1000, 1 << 20, counts=rows[id(lk)])
    assert not lookup_fits(lk.spec, t, 1, 1 << 20, counts=rows[id(lk)])


def test_pages_put_together_are_the_whole_lists(spark):
    """Form (b) against form (a): the pages of a policy, in order, hold its lists item by item."""
    from nestdoc.sources import standin

    from .conftest import SF001

    roles = standin.load_roles(spark, SF001)
    whole = {r.numpoliza: r for r in I.policy_document(roles).collect()}
    pages = {}
    for r in I.policy_document(roles, BuildOptions(max_items=3, stable_inputs=True)).collect():
        pages.setdefault(r.numpoliza, []).append(r)
    assert set(pages) == set(whole)
    for key, rows in pages.items():
        rows.sort(key=lambda r: r.page)
        for col in ("datos_recibos", "datos_tarifa"):
            assert all(len(r[col] or []) <= 3 for r in rows)
            assert [i for r in rows for i in r[col] or []] == (whole[key][col] or [])


def test_null_parent_keys_never_cause_pages(spark):
    parents = spark.createDataFrame([(1,)], "k int")
    kids = spark.createDataFrame([(1, 0)] + [(None, i) for i in range(50)], "k int, v int")
    spec = DocSpec("p", key="k", children=(Child(DocSpec("c"), fk="k", out="kids"),))
    assert set(heavy_key_counts(spec, {"p": parents, "c": kids}, 5, nulls=False).values()) == {0}
    doc = build(spec, {"p": parents, "c": kids}, BuildOptions(max_items=5)).collect()
    assert [(r.page, len(r.kids)) for r in doc] == [(0, 1)]


def test_default_job_output_has_the_columns_of_the_original(spark, tmp_dir):
    import os

    from nestdoc.plans.job import paged, run_job

    for name, df in tables(spark).items():
        df.write.parquet(os.path.join(tmp_dir, "in", f"{name}.parquet"))
    out = os.path.join(tmp_dir, "out")
    run_job(spark, os.path.join(tmp_dir, "in"), out, fmt="parquet")
    plain = spark.read.parquet(out)
    assert plain.columns == [f.name for f in I.policy_document(tables(spark)).schema.fields] and len(plain.columns) == 14
    assert "page" not in plain.schema.simpleString()
    run_job(spark, os.path.join(tmp_dir, "in"), out, fmt="parquet", opts=paged(2))
    assert "page" in spark.read.parquet(out).columns
