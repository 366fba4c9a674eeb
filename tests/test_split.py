"""Bounded documents: light parents keep the plain plan, heavy ones are paged by weight."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from nestdoc import BuildOptions, Child, DocSpec, Lookup, build
from nestdoc.operators.nest import PAGE
from nestdoc.plans import insurance as I
from nestdoc.plans import spec as S
from nestdoc.sources import standin

from .conftest import SF001
from .fixtures import tables


def hash_exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning", plan))


def roles_with_heavy_receipts(spark, n=500):
    roles = dict(standin.load_roles(spark, SF001))
    one = roles["receipts"].limit(1).crossJoin(spark.range(n).withColumnRenamed("id", "_i"))
    more = one.select(*[F.lit(3).cast("bigint").alias(c) if c == "idpoliza" else F.col(c) for c in roles["receipts"].columns])
    roles["receipts"] = roles["receipts"].unionByName(more.withColumn("idrecibo", F.monotonically_increasing_id() + 10**6))
    return roles


LISTS = ("datos_sin", "datos_recibos", "datos_tarifa", "datos_cliente")


def put_together(rows, col):
    """Items of a list by policy, whatever the pages; claims and participants by their own parts."""
    got = {}
    for r in sorted(rows, key=lambda r: (r.numpoliza, r[PAGE] if PAGE in r else 0)):
        items = [x.asDict(recursive=True) for x in (r[col] or [])]
        for x in items:
            x.pop(PAGE, None)
            inner = next((k for k, v in x.items() if isinstance(v, list)), None)
            for y in x.pop(inner) if inner else [None]:
                got.setdefault(r.numpoliza, []).append((str(sorted(x.items())), str(y)))
    return {k: sorted(v) for k, v in got.items()}


def test_one_heavy_key_costs_the_light_ones_nothing(spark):
    roles = roles_with_heavy_receipts(spark)
    plain = I.policy_document(roles)
    opts = BuildOptions(max_items=400, stable_inputs=True)
    heavy = S.measure(I.POLICY, roles, 400)
    assert {p: n for p, n in heavy.counts.items()} == {("datos_recibos",): 1}
    (light_spec, light), (few_spec, few) = S.split(I.POLICY, roles, heavy)
    light_doc = S._build(light_spec, (), light, opts, heavy.light())
    assert hash_exchanges(light_doc) <= hash_exchanges(plain) <= 9
    assert 3 not in {r.numpoliza for r in light_doc.select("numpoliza").collect()}
    doc = build(I.POLICY, roles, opts).collect()
    assert {r[PAGE] for r in doc if r.numpoliza != 3} == {0}
    assert max(len(r.datos_recibos or []) for r in doc) <= 400 and len([r for r in doc if r.numpoliza == 3]) == 2
    whole = plain.collect()
    assert {r.numpoliza for r in doc} == {r.numpoliza for r in whole}
    for col in LISTS:
        assert put_together(doc, col) == put_together(whole, col)


def weigh(row, col):
    return sum(1 + sum(len(v) for v in x.asDict().values() if isinstance(v, list)) for x in (row[col] or []))


@pytest.mark.parametrize("n_claims,n_payments,bound", [(40, 40, 40), (30, 7, 50), (5, 300, 64)])
def test_pages_are_bounded_by_all_items(spark, n_claims, n_payments, bound):
    policies = spark.createDataFrame([(1, "a"), (2, "b")], "numpoliza int, name string")
    claims = spark.range(n_claims).select(F.col("id").alias("idsiniestro"), F.lit(1).alias("idpoliza"))
    claims = claims.unionByName(spark.createDataFrame([(9001, 2)], "idsiniestro bigint, idpoliza int"))
    payments = spark.range(n_claims * n_payments).select((F.col("id") % n_claims).alias("idsiniestro"), F.col("id").alias("idpago"))
    t = {"policies": policies, "claims": claims, "payments": payments}
    spec = I.POLICY.with_children("datos_sin")
    rows = build(spec, t, BuildOptions(max_items=bound)).collect()
    assert all(weigh(r, "datos_sin") <= 2 * bound for r in rows)
    pages = sorted(r[PAGE] for r in rows if r.numpoliza == 1)
    assert pages == list(range(len(pages)))
    got = sorted((c.idsiniestro, p.idpago) for r in rows for c in r.datos_sin for p in c.datos_pago or [])
    assert got == sorted((i % n_claims, i) for i in range(n_claims * n_payments))
    assert [(len(r.datos_sin), r[PAGE]) for r in rows if r.numpoliza == 2] == [(1, 0)]


def test_a_thousand_claims_of_a_thousand_payments(spark):
    n = 1000
    policies = spark.createDataFrame([(1, "a")], "numpoliza int, name string")
    claims = spark.range(n).select(F.col("id").alias("idsiniestro"), F.lit(1).alias("idpoliza"))
    payments = spark.range(n * n).select((F.col("id") % n).alias("idsiniestro"), F.col("id").alias("idpago"))
    spec = I.POLICY.with_children("datos_sin")
    doc = build(spec, {"policies": policies, "claims": claims, "payments": payments}, BuildOptions(max_items=n))
    weight = F.aggregate("datos_sin", F.lit(0), lambda a, x: a + F.size(x["datos_pago"]))
    got = doc.agg(F.max(weight).alias("most"), F.sum(weight).alias("all"), F.count("*").alias("pages")).collect()[0]
    assert got["most"] <= 2 * n and got["all"] == n * n and got["pages"] >= n // 2


def test_participants_weigh_their_clients_accounts(spark):
    t = tables(spark)
    t["accounts"] = t["accounts"].unionByName(
        t["accounts"].where("idcuenta = 70").crossJoin(spark.range(20)).withColumn("idcuenta", (F.col("id") + 100).cast("int")).drop("id")
    )
    rows = build(I.POLICY, t, BuildOptions(max_items=6)).collect()
    assert all(weigh(r, "datos_cliente") <= 12 for r in rows)
    whole = I.policy_document(t).collect()
    assert put_together(rows, "datos_cliente") == put_together(whole, "datos_cliente")


def test_no_list_is_weighed_where_bounds_settle_it(spark):
    heavy = S.measure(I.POLICY, tables(spark), 100)
    assert not heavy.keys and not heavy.counts


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_lookup_keys_meet_a_sent_side(spark, how):
    people = spark.range(0, 3000, 1, 6).select(
        "id", F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 17 == 0, None).otherwise(F.col("id") % 400).alias("client")
    )
    clients = spark.range(0, 390).select(F.col("id").alias("client"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    accounts = spark.range(0, 900).select(F.col("id").alias("account"), (F.col("id") % 300).alias("client"))
    side = DocSpec("clients", key="client", children=(Child(DocSpec("accounts"), fk="client", out="accounts"),))
    spec = DocSpec("people", lookups=(Lookup(side, on="client", how=how),))
    t = {"people": people, "clients": clients, "accounts": accounts}
    opts = BuildOptions(lookup_broadcast_rows=0, lookup_hot_rows=1000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = build(spec, t, opts)
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = sorted(map(str, got.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Union" in plan and "BroadcastHashJoin" in plan
    assert rows == sorted(map(str, build(spec, t).collect()))
