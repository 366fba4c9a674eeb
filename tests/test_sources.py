from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from nestdoc.sources import SCHEMAS, load_tables, read_delimited
from nestdoc.sources.delimited import default_paths

SCHEMA = StructType(
    [StructField("id", IntegerType()), StructField("name", StringType()), StructField("amount", DoubleType())]
)


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_binding_is_by_position_not_header_name(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "a.csv"), "other,names,here\n1,a,2.5\n")
    row = read_delimited(spark, p, SCHEMA).collect()[0]
    assert row.asDict() == {"id": 1, "name": "a", "amount": 2.5}


def test_first_line_always_skipped(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "b.csv"), "1,a,1.0\n2,b,2.0\n")
    assert [r.id for r in read_delimited(spark, p, SCHEMA).collect()] == [2]


def test_permissive_parsing(spark, tmp_dir):
    text = "id,name,amount\nx,bad,1.0\n2,short\n3,long,3.0,extra\n4,,4.0\n5, ,5.0\n6,\"a,b\",6.0\n"
    p = write(os.path.join(tmp_dir, "c.csv"), text)
    got = [r.asDict() for r in read_delimited(spark, p, SCHEMA).collect()]
    assert got == [
        {"id": None, "name": "bad", "amount": 1.0},  # bad number gives null
        {"id": 2, "name": "short", "amount": None},  # missing field gives null
        {"id": 3, "name": "long", "amount": 3.0},  # extra field is cut
        {"id": 4, "name": None, "amount": 4.0},  # empty field gives null
        {"id": 5, "name": " ", "amount": 5.0},  # one blank stays a blank
        {"id": 6, "name": "a,b", "amount": 6.0},  # quoted comma
    ]
    assert all(f.nullable for f in read_delimited(spark, p, SCHEMA).schema)


def test_strict_mode_fails_on_bad_content_and_header(spark, tmp_dir):
    bad = write(os.path.join(tmp_dir, "d.csv"), "id,name,amount\nx,bad,1.0\n")
    with pytest.raises(Exception):
        read_delimited(spark, bad, SCHEMA, strict=True).collect()
    renamed = write(os.path.join(tmp_dir, "e.csv"), "ident,name,amount\n1,a,1.0\n")
    with pytest.raises(Exception):
        read_delimited(spark, renamed, SCHEMA, strict=True).collect()
    good = write(os.path.join(tmp_dir, "f.csv"), "id,name,amount\n1,a,1.0\n")
    assert read_delimited(spark, good, SCHEMA, strict=True).count() == 1


def test_missing_source_fails_the_whole_load(spark, tmp_dir):
    paths = default_paths(tmp_dir)
    for name in SCHEMAS:
        if name != "claims":
            write(paths[name], ",".join(f.name for f in SCHEMAS[name]) + "\n")
    with pytest.raises(AnalysisException):
        load_tables(spark, paths=paths)


def test_load_all_eight_tables(spark, tmp_dir):
    from .synth_tables import synth_all

    for name, df in synth_all(spark, {"policies": 30, "claims": 40, "payments": 50, "receipts": 20,
                                      "tariffs": 30, "clients": 10, "accounts": 10, "participants": 10}).items():
        df.write.mode("overwrite").option("header", True).csv(os.path.join(tmp_dir, f"{name}.csv"))
    tables = load_tables(spark, tmp_dir)
    assert set(tables) == set(SCHEMAS)
    for name, df in tables.items():
        assert [f.name for f in df.schema] == [f.name for f in SCHEMAS[name]]
    assert tables["tariffs"].count() == 60 and tables["payments"].count() == 50
