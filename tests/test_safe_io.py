"""Tables replaced safely, files by size, checked loads, and accounts of rows."""

from __future__ import annotations

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from nestdoc import BuildOptions
from nestdoc.plans import insurance as I
from nestdoc.plans.accounts import accounted
from nestdoc.plans.job import run_job
from nestdoc.sinks import publish, read_clustered, write_clustered
from nestdoc.sinks.writers import FILES, _file_plan, files_of
from nestdoc.sources import HeaderError, SCHEMAS, load_checked, load_tables, read_checked
from nestdoc.sources.delimited import default_paths, first_line

from .fixtures import tables


# ------------------------------------------------------------------ K3
def test_failed_publish_leaves_the_old_rows(spark):
    good = spark.range(10).withColumn("v", F.lit("old"))
    publish(good, "nestdoc_safe")
    before = spark.sql("DESCRIBE TABLE EXTENDED nestdoc_safe").where("col_name = 'Location'").collect()[0]["data_type"]
    bad = spark.range(0, 1000, 1, 4).withColumn("v", F.when(F.col("id") == 999, F.raise_error(F.lit("midway"))).otherwise("new"))
    with pytest.raises(Exception, match="midway"):
        publish(bad, "nestdoc_safe")
    assert [r.v for r in spark.table("nestdoc_safe").select("v").distinct().collect()] == ["old"]
    assert len(os.listdir(os.path.dirname(before.replace("file:", "")))) == 1  # nothing is left of the failed one


def test_publish_swaps_and_keeps_one_old_version(spark):
    for k in range(4):
        rep = publish(spark.range(k + 1), "nestdoc_swap")
        assert rep.rows == k + 1 == spark.table("nestdoc_swap").count()
    home = spark.sql("DESCRIBE TABLE EXTENDED nestdoc_swap").where("col_name = 'Location'").collect()[0]["data_type"]
    assert len(os.listdir(os.path.dirname(home.replace("file:", "")))) == 2
    publish(spark.range(5), "nestdoc_swap", mode="append")
    assert spark.table("nestdoc_swap").count() == 9
    publish(spark.range(2).withColumn("more", F.lit(1)), "nestdoc_swap")  # other columns
    assert spark.table("nestdoc_swap").columns == ["id", "more"] and spark.table("nestdoc_swap").count() == 2


def test_a_reader_that_has_begun_reads_on(spark):
    publish(spark.range(7), "nestdoc_reader")
    old = spark.table("nestdoc_reader")
    old_files = set(old.inputFiles())
    publish(spark.range(3), "nestdoc_reader")
    assert all(os.path.exists(f.replace("file://", "")) for f in old_files)
    assert spark.table("nestdoc_reader").count() == 3


def test_publish_over_a_table_of_another_kind(spark):
    spark.range(4).write.mode("overwrite").saveAsTable("nestdoc_managed")
    publish(spark.range(6), "nestdoc_managed")
    assert spark.table("nestdoc_managed").count() == 6


# ------------------------------------------------------------------ K2
def sizes(path):
    return [os.path.getsize(f) for f in glob.glob(os.path.join(path, "*.parquet"))]


def test_files_have_the_wanted_size_and_keys_prune_them(spark, tmp_dir):
    path = os.path.join(tmp_dir, "clustered")
    n = 60_000
    rows = spark.range(0, n, 1, 7).select((F.col("id") * 7919 % n).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    target = 150_000
    rep = write_clustered(rows, path, ["k"], file_bytes=target, pieces=64)
    assert rep.rows == n
    got = sizes(path)
    assert len(got) > 12 and all(target / 2 <= s <= 2 * target for s in got)
    assert len(files_of(spark, path, 500, 500)) / len(got) < 0.1
    found = read_clustered(spark, path, "k", 500, 700)
    assert sorted(r.k for r in found.collect()) == list(range(500, 701))
    assert len(found.inputFiles()) <= 2
    assert read_clustered(spark, path, "k", low=n).count() == 0 and read_clustered(spark, path, "k").count() == n
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, rows.collect()))


def test_a_key_with_a_third_of_the_rows_makes_files_of_its_own(spark, tmp_dir):
    path = os.path.join(tmp_dir, "hot")
    rows = spark.range(0, 30_000, 1, 5).select(
        F.when(F.col("id") % 3 == 0, 77).when(F.col("id") % 1000 == 1, None).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"), F.create_map(F.lit("a"), F.col("id")).alias("m"),
    )
    write_clustered(rows, path, ["k"], file_bytes=120_000, pieces=8)
    got = sizes(path)
    assert len(got) > 10 and max(got) <= 240_000
    assert read_clustered(spark, path, "k", 77, 77).count() == 10_001
    assert spark.read.parquet(path).where("k is null").count() == rows.where("k is null").count() > 0


def test_clustered_write_of_a_document_and_of_no_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "doc")
    doc = I.policy_document(tables(spark))
    assert write_clustered(doc, path, ["numpoliza"], file_bytes=1 << 20).rows == 3
    assert len(sizes(path)) == 1 and os.path.isdir(os.path.join(path, FILES))
    assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, doc.collect()))
    assert write_clustered(doc.limit(0), path, ["numpoliza"]).rows == 0
    assert spark.read.parquet(path).count() == 0 and read_clustered(spark, path, "numpoliza", 1).count() == 0


def test_file_plan():
    assert _file_plan([], 10) == ([], 0)
    plan, n = _file_plan([("a", 4, 1), ("b", 5, 2), ("c", 4, 1), ("d", 31, 9), ("e", 0, 0), ("f", 3, 1)], 10)
    assert plan == [("a", 0, 1, 1), ("b", 0, 1, 2), ("c", 1, 1, 1), ("d", 2, 3, 9), ("f", 5, 1, 1)] and n == 6


# ------------------------------------------------------------------ S0, S9
SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("amount", DoubleType())])


def write(path, text, opener=open):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with opener(path, "wt") as f:
        f.write(text)
    return path


def good_files(root):
    paths = default_paths(root)
    for name in SCHEMAS:
        write(paths[name], ",".join(f.name for f in SCHEMAS[name]) + "\n")
    return paths


def test_bad_header_raises_when_tables_are_loaded(spark, tmp_dir):
    paths = good_files(tmp_dir)
    assert set(load_tables(spark, tmp_dir, strict=True)) == set(SCHEMAS)
    assert set(load_checked(spark, tmp_dir).tables) == set(SCHEMAS)
    names = [f.name for f in SCHEMAS["claims"]]
    write(paths["claims"], ",".join([names[1], names[0], *names[2:]]) + "\n")
    for load in (lambda: load_tables(spark, tmp_dir, strict=True), lambda: load_checked(spark, tmp_dir)):
        with pytest.raises(HeaderError, match="claims"):
            load()
    load_tables(spark, tmp_dir)  # by position: names are not read


def test_headers_of_all_files_plain_and_compressed(spark, tmp_dir):
    write(os.path.join(tmp_dir, "t", "a.csv"), "id,name,amount\n1,a,1.0\n")
    packed = write(os.path.join(tmp_dir, "t", "b.csv.gz"), "id,name,amount\n2,b,2.0\n", gzip.open)
    assert first_line(spark, packed) == "id,name,amount"
    good, bad = read_checked(spark, os.path.join(tmp_dir, "t"), SCHEMA)
    assert good.count() == 2 and bad.count() == 0
    write(os.path.join(tmp_dir, "t", "c.csv"), "id,amount,name\n")
    with pytest.raises(HeaderError, match="c.csv"):
        read_checked(spark, os.path.join(tmp_dir, "t"), SCHEMA)


def test_bad_rows_come_back_with_their_lines(spark, tmp_dir):
    lines = ["1,a,1.5", "x,b,2.0", "3,c", "4,d,4.0,more", "5,,", "6,f,abc", '7,"g,h",7.0', "8,i,8.0"]
    path = write(os.path.join(tmp_dir, "rows.csv"), "id,name,amount\n" + "\n".join(lines) + "\n")
    good, bad = read_checked(spark, path, SCHEMA)
    assert sorted(r.id for r in good.collect()) == [1, 5, 7, 8]
    assert sorted(r.line for r in bad.collect()) == sorted([lines[1], lines[2], lines[3], lines[5]])
    assert all(r.file.endswith("rows.csv") for r in bad.collect())
    assert good.select("name").count() + bad.count() == len(lines)
    assert sorted(r[0] for r in good.select("name").na.fill("-").collect()) == ["-", "a", "g,h", "i"]  # whatever is read


# ------------------------------------------------------------------ K5, C8
def test_accounts_add_up_without_another_scan(spark, tmp_dir):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("accounts-plan", "no job")
    doc, finish = accounted(I.POLICY, tables(spark))
    assert not tracker.getJobIdsForGroup("accounts-plan")  # planning runs nothing
    spark.sparkContext.setJobGroup("accounts", "one write")
    doc.write.parquet(os.path.join(tmp_dir, "doc"))
    got = {a.name: a for a in finish()}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = doc._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == len(SCHEMAS)  # each input once
    assert tracker.getJobIdsForGroup("accounts")
    for a in got.values():
        assert a.copied or a.rows == a.in_document + a.no_key + a.left_out
    assert (got["policies"].rows, got["policies"].in_document, got["policies"].left_out) == (5, 3, 2)
    assert (got["datos_sin"].rows, got["datos_sin"].in_document, got["datos_sin"].no_key) == (4, 3, 1)
    pay = got["datos_sin/datos_pago"]
    assert (pay.rows, pay.in_document, pay.left_out) == (4, 3, 1)  # one has no claim
    assert (got["datos_recibos"].in_document, got["datos_recibos"].left_out) == (3, 1)
    assert got["datos_cliente/@idcliente/datos_cuenta"].copied


def test_job_reports_accounts(spark, tmp_dir):
    for name, df in tables(spark).items():
        df.write.parquet(os.path.join(tmp_dir, "in", f"{name}.parquet"))
    out = os.path.join(tmp_dir, "out")
    rep = run_job(spark, os.path.join(tmp_dir, "in"), out, fmt="parquet", accounts=True)
    plain = run_job(spark, os.path.join(tmp_dir, "in"), out + "2", fmt="parquet")
    assert plain.accounts == () and len(rep.accounts) == len(SCHEMAS) and rep.rows == plain.rows == 3
    assert sorted(map(str, spark.read.parquet(out).collect())) == sorted(map(str, spark.read.parquet(out + "2").collect()))
    with pytest.raises(ValueError, match="whole lists"):
        accounted(I.POLICY, tables(spark), BuildOptions(max_items=3))
