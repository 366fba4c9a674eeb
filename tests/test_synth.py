from __future__ import annotations

import collections

from pyspark.sql import functions as F

from nestdoc.functions.dates import OPEN_END
from nestdoc.plans import insurance as I
from . import synth_tables as G
from nestdoc.sources.schemas import SCHEMAS


def test_schemas_and_counts(spark):
    t = G.synth_all(spark)
    for name, df in t.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SCHEMAS[name]], name
    counts = {n: df.count() for n, df in t.items()}
    assert counts == {**G.DEFAULT_ROWS, "tariffs": 2 * G.DEFAULT_ROWS["tariffs"]}


def test_end_to_end_gives_one_thousand_documents(spark):
    # policies 1..999 have no participant and drop out of the inner join
    doc = I.policy_document(G.synth_all(spark))
    assert doc.count() == 1000
    keys = doc.agg(F.min("numpoliza"), F.max("numpoliza")).first()
    assert tuple(keys) == (1000, 1999)


def test_policy_rules(spark):
    p = G.synth(spark, "policies", 500).collect()
    for r in p:
        assert r.fecha_sol < r.fecha_efecto <= r.fecha_vencimiento
        if r.pol_estado == "PV":
            assert (r.fecha_baja, r.fecha_suspension, r.causa_baja, r.causa_suspen) == (OPEN_END, OPEN_END, " ", " ")
        if r.pol_estado == "PA":
            assert r.fecha_baja != OPEN_END and r.causa_baja in G.END_CAUSES and r.fecha_suspension == OPEN_END
        if r.pol_estado == "PS":
            assert r.fecha_suspension != OPEN_END and r.causa_suspen in G.SUSPENSION_CAUSES and r.causa_baja == " "
    assert {r.pol_estado for r in p} == set(G.POLICY_STATES)
    assert {r.formapago for r in p} == set(G.PAYMENT_FORMS)


def test_other_rules(spark):
    for r in G.synth(spark, "accounts", 200).collect():
        assert r.iban_total[4:] == r.empresa + r.oficina + r.digcontrol + r.contrato and len(r.digcontrol) == 3
        assert (r.fecha_baja == OPEN_END) == (r.situacion == "A") and r.fecha_baja >= r.fecha_alta
    for r in G.synth(spark, "clients", 200).collect():
        assert "," not in r.direccion and "\n" not in r.direccion and r.numdni == r.numdni.upper()
        assert len(r.apellidos.split()) >= 2
    for r in G.synth(spark, "claims", 300).collect():
        assert (r.fecha_cierre == OPEN_END) == (r.estado == "AB") and 1 <= r.idpoliza <= 1999
    for r in G.synth(spark, "payments", 300).collect():
        assert (r.fecha_pago == OPEN_END) == (r.estado == "AN") and 100 <= r.importe_pago <= 99999
    for r in G.synth(spark, "receipts", 300).collect():
        assert r.fecha_emision < r.fecha_efecto and 1 <= r.importe_consorcio <= 99 and 1 <= r.importe_comision <= 34
    for r in G.synth(spark, "participants", 300).collect():
        assert r.numpoliza == r.idcliente + 999 and (r.fecha_baja == OPEN_END) == (r.estado == "B")
    tariffs = collections.defaultdict(list)
    for r in G.synth(spark, "tariffs", 100).collect():
        tariffs[r.num_poliza].append(r)
    for rows in tariffs.values():
        assert sorted(x.tarifa for x in rows) == ["TF1", "TS1"]
        assert [x.importe_prima for x in rows][1] == "0" and len({x.situacion for x in rows}) == 1


def test_synthesis_does_not_depend_on_partitioning(spark):
    a = G.policies(spark.range(1, 301).repartition(1)).collect()
    b = G.policies(spark.range(1, 301).repartition(9)).collect()
    assert sorted(a) == sorted(b)


def test_missing_client_gives_null_client_fields(spark):
    doc = I.policy_document(G.synth_all(spark))
    last = doc.where("numpoliza = 1999").first()  # participant 1000 has no client row
    assert last.datos_cliente[0].idcliente == 1000 and last.datos_cliente[0].nombre is None


def test_run_job_end_to_end(spark, tmp_dir):
    import os

    from nestdoc.plans.job import run_job

    src = os.path.join(tmp_dir, "src")
    for name, df in G.synth_all(spark).items():
        df.write.mode("overwrite").option("header", True).csv(os.path.join(src, f"{name}.csv"))
    report = run_job(spark, src, os.path.join(tmp_dir, "out"), files=2)
    assert report.rows == 1000
    assert spark.read.parquet(os.path.join(tmp_dir, "out")).count() == 1000


def test_module_entry_point(spark, tmp_dir):
    import os

    from nestdoc.plans.job import main

    src = os.path.join(tmp_dir, "src")
    for name, df in G.synth_all(spark).items():
        df.write.mode("overwrite").option("header", True).csv(os.path.join(src, f"{name}.csv"))
    out = os.path.join(tmp_dir, "out")
    report = main([src, out, "--files", "1", "--left-participants"])
    assert report.rows == 1999  # every policy has a tariff; participants kept optional
    doc = spark.read.parquet(out)
    assert "page" not in doc.columns
    report = main([src, out, "--max-items", "1000"])
    doc = spark.read.parquet(out)
    assert report.rows == 1000 and doc.where("page <> 0").count() == 0


def test_parquet_inputs_end_to_end(spark, tmp_dir):
    import os

    from nestdoc.sources import load_tables

    for name, df in G.synth_all(spark).items():
        df.write.mode("overwrite").parquet(os.path.join(tmp_dir, f"{name}.parquet"))
    tables = load_tables(spark, tmp_dir, fmt="parquet")
    assert I.policy_document(tables).count() == 1000
