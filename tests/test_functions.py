from __future__ import annotations

from pyspark.sql import functions as F

from nestdoc.functions import columns as C
from nestdoc.functions import dates as D
from nestdoc.functions import text as T


def test_columns(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "k int, `a.b` string, c double")
    assert C.all_except(df, ["k"]) == ["a.b", "c"]
    assert C.project_all_except(df, "c").columns == ["k", "a.b"]
    packed = C.pack(df, "s", exclude=["k"])
    assert [f.name for f in packed.schema["s"].dataType.fields] == ["a.b", "c"]
    assert C.unpack(packed, "s", keep=["k"]).collect()[0].asDict() == {"k": 1, "a.b": "a", "c": 2.0}
    assert C.rename_one(df, "zz", "y").columns == df.columns
    assert C.rename_suffix(df).columns == ["k_n", "a.b_n", "c_n"]
    assert C.rename_suffix(df, ["c", "missing"], "_x").columns == ["k", "a.b", "c_x"]


def test_dates(spark):
    df = spark.createDataFrame([("9999-12-31",), ("2021-03-01",), ("0001-01-01",)], "d string")
    got = df.select(D.is_open("d").alias("o"), D.is_open_start("d").alias("s"), D.day_before("d").alias("b")).collect()
    assert [tuple(r) for r in got[:2]] == [(True, False, "9999-12-30"), (False, False, "2021-02-28")]
    assert tuple(got[2])[:2] == (False, True)
    assert df.select(D.to_day("d")).collect()[0][0].year == 9999
    run = spark.range(1).select(*[v.alias(k) for k, v in D.run_date_columns("2024-03-01").items()]).first()
    assert run.asDict() == {"run_date": "2024-03-01", "run_year": 2024, "run_day_before": "2024-02-29"}
    assert D.days_between("2020-10-11", "2020-10-12") == 2


def test_text(spark):
    df = spark.createDataFrame([("ES9121000418450200051332", "a,b\nc")], "iban string, t string")
    parts = df.select(*[v.alias(k) for k, v in T.split_account("iban").items()]).first().asDict()
    assert parts == {"empresa": "2100", "oficina": "0418", "digcontrol": "450", "contrato": "200051332"}
    row = df.select(T.clean_text("t").alias("a"), T.clean_text("t", upper=True).alias("b")).first()
    assert (row.a, row.b) == ("a;b c", "A;B C")
    assert df.select(T.join_text("|", F.lit(1), "t")).first()[0] == "1|a,b\nc"
    got = spark.range(5).select(T.pick(["x", "y"], F.col("id")).alias("p")).collect()
    assert [r.p for r in got] == ["x", "y", "x", "y", "x"]
