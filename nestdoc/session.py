"""Session helpers: a builder with scale-minded defaults and the shared scratch folder.

Nothing here overrides what a cluster already configures: options are only set
when the session does not carry them yet.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Defaults for a session this library creates itself (tests, bench, local runs).
# On a cluster the same keys come from spark-defaults / spark-submit and win.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution: coalesces small shuffle partitions, splits skewed join
    # partitions and turns a join into a broadcast once the runtime size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Checkpoint files (heavy-key pages, checkpointed lists) are removed once
    # their frames are no longer referenced, instead of piling up in the
    # shared checkpoint folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Lists of structs are written in the standard 3-level layout
    # (x.list.element), which warehouse loaders read back as lists.
    "spark.sql.parquet.writeLegacyFormat": "false",
}


def get_spark(
    app: str = "nestdoc",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or build one with the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Read from the session's ``spark.checkpoint.dir`` (Spark also sets the
    context's checkpoint folder from it). Only when the session has none and
    its master is this process (a test on one machine) is a fresh local folder
    taken, set on the context and removed when the process ends; on a cluster
    a missing setting is an error, as executors do not share local folders.
    ``spark.checkpoint.dir`` itself cannot be changed on a running session.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if not path and current:
        path = current.rstrip("/").rsplit("/", 1)[0]  # Spark adds a unique subfolder
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="nestdoc-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    if current is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/nestdoc-scratch/{name}-{uuid.uuid4().hex}"



def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for each Spark application, so that
    functions which run there find it on any executor."""
    sc = spark.sparkContext
    if getattr(sc, "_nestdoc_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="nestdoc-ship-")) / "nestdoc-package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._nestdoc_shipped = True
