from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq

from nestdoc.plans import insurance as I
from nestdoc.sinks import persist, publish, write_parquet
from nestdoc.sinks.writers import LEVELS, MEMORY_AND_DISK

from .fixtures import tables


def test_write_reports_rows_and_overwrites(spark, tmp_dir):
    path = os.path.join(tmp_dir, "doc")
    doc = I.policy_document(tables(spark))
    rep = write_parquet(doc, path)
    assert rep.rows == 3 and rep.target == path and rep.seconds >= 0
    rep2 = write_parquet(doc.limit(1), path)
    assert rep2.rows == 1 and spark.read.parquet(path).count() == 1


def test_file_count(spark, tmp_dir):
    path = os.path.join(tmp_dir, "doc")
    write_parquet(I.policy_document(tables(spark)), path, files=2)
    assert len(glob.glob(os.path.join(path, "part-*.parquet"))) == 2


def test_three_level_list_layout(spark, tmp_dir):
    path = os.path.join(tmp_dir, "doc")
    write_parquet(I.policy_document(tables(spark)), path, files=1)
    f = glob.glob(os.path.join(path, "part-*.parquet"))[0]
    paths = {".".join(c.path.split(".")[:3]) for c in pq.ParquetFile(f).schema}
    assert "datos_sin.list.element" in paths
    back = spark.read.parquet(path)
    assert back.schema["datos_sin"].dataType.elementType["datos_pago"] is not None


def test_publish_as_table(spark):
    doc = I.policy_document(tables(spark))
    rep = publish(doc, "nestdoc_policy_document")
    assert rep.rows == 3
    assert spark.table("nestdoc_policy_document").count() == 3
    publish(doc.limit(2), "nestdoc_policy_document")
    assert spark.table("nestdoc_policy_document").count() == 2


def test_write_is_labelled(spark, tmp_dir):
    write_parquet(I.policy_document(tables(spark)), os.path.join(tmp_dir, "doc"), label="final load")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("nestdoc-write")


def test_persist_levels(spark):
    df = tables(spark)["claims"]
    assert persist(df, None) is df
    for name in LEVELS:
        p = persist(df, name)
        assert p.storageLevel == LEVELS[name]
        p.unpersist()
    assert MEMORY_AND_DISK.useDisk and MEMORY_AND_DISK.useMemory and not MEMORY_AND_DISK.useOffHeap


def test_checkpoint_folder_is_usable(spark):
    from nestdoc.session import ensure_checkpoint_dir, scratch_path

    root = ensure_checkpoint_dir(spark)
    assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/nestdoc-scratch/x-")
    assert spark.range(5).checkpoint(eager=True).count() == 5


def test_failed_write_is_reported_with_its_seconds(spark, tmp_dir, caplog):
    import pytest

    bad = tables(spark)["claims"].selectExpr("raise_error('no') as x")
    with caplog.at_level("ERROR", logger="nestdoc"), pytest.raises(Exception, match="no"):
        write_parquet(bad, f"{tmp_dir}/bad")
    assert "failed after" in caplog.text and f"{tmp_dir}/bad" in caplog.text


def test_callers_job_group_comes_back(spark, tmp_dir):
    sc = spark.sparkContext
    sc.setJobGroup("mine", "my work")
    write_parquet(tables(spark)["claims"], f"{tmp_dir}/x")
    assert sc.getLocalProperty("spark.jobGroup.id") == "mine" and sc.getLocalProperty("spark.job.description") == "my work"
    sc.setLocalProperty("spark.jobGroup.id", None)
    sc.setLocalProperty("spark.job.description", None)


def test_no_local_scratch_on_a_cluster():
    import pytest

    from nestdoc.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
