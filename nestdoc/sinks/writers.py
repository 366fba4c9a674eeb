"""Sinks for documents (K1-K5) and storage levels (D3).

The write is the job's only action. It keeps the plan's parallelism: the last
join stage writes one file per task unless ``files`` asks for a number, in
which case the rows are repartitioned (a shuffle, but every task stays bounded;
collapsing to one task is never done implicitly).
"""

from __future__ import annotations

import logging
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from ..functions.columns import q
from ..session import scratch_path

# --- fixed values: the three storage levels offered (disk, memory, off-heap,
# deserialized, replication) ---------------------------------------------------
MEMORY_DISK_OFFHEAP = StorageLevel(True, True, True, False, 1)
MEMORY_AND_DISK = StorageLevel(True, True, False, False, 1)
MEMORY_ONLY = StorageLevel(False, True, False, False, 1)
# ------------------------------------------------------------------------------

log = logging.getLogger("nestdoc")

LEVELS = {
    "memory_disk_offheap": MEMORY_DISK_OFFHEAP,
    "memory_and_disk": MEMORY_AND_DISK,
    "memory": MEMORY_ONLY,
}


@dataclass(frozen=True)
class RunReport:
    """What a sink reports: rows written, seconds taken, where to."""

    target: str
    rows: int
    seconds: float
    accounts: tuple = ()  # what became of every input's rows, where asked for (plans.accounts)


@contextmanager
def job_group(df: DataFrame, group: str, description: str):
    """Label the jobs run inside the block (K4); the caller's own labels come back after it."""
    sc = df.sparkSession.sparkContext
    names = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
    before = {name: sc.getLocalProperty(name) for name in names}
    sc.setJobGroup(group, description)
    try:
        yield
    finally:
        for name, value in before.items():
            sc.setLocalProperty(name, value)


@contextmanager
def timed(target: str):
    """Seconds of the block so far; a failure is logged with them and raised on (K5)."""
    start = time.monotonic()
    try:
        yield lambda: time.monotonic() - start
    except Exception:
        log.error("writing %s failed after %.1f s", target, time.monotonic() - start)
        raise


def _prepare(df: DataFrame, files: int | None, name: str):
    if files is not None:
        if files < 1:
            raise ValueError("files must be at least 1")
        df = df.repartition(files)
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    files: int | None = None,
    partition_by: list[str] | None = None,
    label: str = "document write",
) -> RunReport:
    """Write ``df`` as Parquet (K1, K2); the row count comes from the same pass (K5)."""
    with timed(path) as seconds:
        observed, obs = _prepare(df, files, "parquet_sink")
        writer = observed.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with job_group(df, "nestdoc-write", label):
            writer.parquet(path)
        return RunReport(path, int(obs.get["rows"]), seconds())


def _fs(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Spark's own writers see them."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def _data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Name and bytes of the data files in a folder."""
    fs, where = _fs(spark, path)
    found = {f.getPath().getName(): f.getLen() for f in fs.listStatus(where)}
    return {name: n for name, n in found.items() if not name.startswith(("_", "."))}


def publish(
    df: DataFrame,
    table: str,
    *,
    mode: str = "overwrite",
    files: int | None = None,
    label: str = "document publish",
    keep: int = 1,
) -> RunReport:
    """Write ``df`` as a Parquet table, replacing its rows (K3).

    ``overwrite`` is safe for readers: the rows are written to a new folder
    beside the table's present one, and only when that write has ended is the
    table pointed at it, which is one change in the catalog. A write that fails
    leaves the table as it was, and its own folder is removed. A reader that
    has begun goes on with the old files, of which the last ``keep`` versions
    stay. A table that is replaced by one of other columns, or that was not
    written by this function, is dropped and made anew after the write, so it
    is missing for that moment only.

    ``append`` adds the rows to the table's present folder.

    Lists are stored in the standard 3-level list layout, so readers that
    infer lists from Parquet see lists.
    """
    spark = df.sparkSession
    with timed(table) as seconds:
        observed, obs = _prepare(df, files, "table_sink")
        with job_group(df, "nestdoc-publish", label):
            if mode != "overwrite":
                observed.write.mode(mode).format("parquet").saveAsTable(table)
            else:
                home = _versions(spark, table)
                path = f"{home}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
                try:
                    observed.write.parquet(path)
                except Exception:
                    fs, where = _fs(spark, path)
                    fs.delete(where, True)
                    raise
                _point(spark, table, home, path)
                fs, where = _fs(spark, home)
                old = sorted(f.getPath().getName() for f in fs.listStatus(where))
                for name in old[: max(len(old) - 1 - keep, 0)]:
                    fs.delete(_fs(spark, f"{home}/{name}")[1], True)
        return RunReport(table, int(obs.get["rows"]), seconds())


def _parts(spark: SparkSession, table: str) -> tuple[str, str]:
    *database, name = [p.strip("`") for p in table.split(".")]
    return (database[-1] if database else spark.catalog.currentDatabase()), name


def _versions(spark: SparkSession, table: str) -> str:
    """The folder that holds a table's versions."""
    database, name = _parts(spark, table)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}__versions"


def _point(spark: SparkSession, table: str, home: str, path: str) -> None:
    """Make the table read the files at ``path``."""
    database, name = _parts(spark, table)
    full, quoted = f"`{database}`.`{name}`", path.replace("\\", "\\\\").replace("'", "\\'")
    if spark.catalog.tableExists(full):
        now = spark.table(full).schema
        detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect()}
        same = [(f.name, f.dataType) for f in now] == [(f.name, f.dataType) for f in spark.read.parquet(path).schema]
        if same and f"/{name}__versions/" in (detail.get("Location") or ""):
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{quoted}'")
            spark.catalog.refreshTable(full)
            return
        spark.sql(f"DROP TABLE {full}")
    spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{quoted}'")


FILES = "_files"  # the folder with the key range of each data file; readers of the data skip it


def write_clustered(
    df: DataFrame,
    path: str,
    keys: list[str],
    *,
    file_bytes: int = 128 * 1024 * 1024,
    pieces: int | None = None,
    mode: str = "overwrite",
    label: str = "clustered write",
) -> RunReport:
    """Write ``df`` as Parquet files of about ``file_bytes`` each, in ranges of ``keys`` (K2).

    The rows are range-sorted into ``pieces`` (by default the session's
    shuffle partitions) and written once to the shared folder, where each
    piece's bytes are measured as they are on disk. Neighbouring pieces
    together make a file of the wanted size, and a piece of more is cut by its
    rows. Equal keys are spread by a hash of the row, so a key with a mass of
    rows is no single piece. Beside the data lies the key range of every file,
    from which :func:`read_clustered` chooses the files of a key or range.
    """
    if file_bytes < 1:
        raise ValueError("file_bytes must be at least 1")
    spark = df.sparkSession
    with timed(path) as seconds, job_group(df, "nestdoc-write", label):
        pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
        plain = [f.name for f in df.schema.fields if not _holds_map(f.dataType)]
        by = [*[q(k) for k in keys], F.xxhash64(*[q(c) for c in plain])]
        staged = scratch_path(spark, "clustered")
        df.repartitionByRange(pieces, *by).sortWithinPartitions(*by).write.parquet(staged)
        rows = spark.read.schema(df.schema).parquet(staged)
        counts = {
            r["f"]: r["n"] for r in rows.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()
        }  # one row for each piece
        plan, n_files = _file_plan([(f, b, counts.get(f, 0)) for f, b in sorted(_data_files(spark, staged).items())], file_bytes)
        to_file = spark.createDataFrame(plan or [("", 0, 1, 1)], "_f string, _first int, _cuts int, _n long")
        placed = rows.select("*", F.col("_metadata.file_name").alias("_name"), F.col("_metadata.row_index").alias("_index"))
        number = F.col("_first") + F.floor(F.col("_index") * F.col("_cuts") / F.col("_n")).cast("int")
        placed = placed.join(F.broadcast(to_file), F.col("_name") == F.col("_f")).select(*[q(c) for c in df.columns], number.alias("_file"))
        obs = Observation("clustered_sink")
        out = placed.repartitionById(max(n_files, 1), F.col("_file")).drop("_file").sortWithinPartitions(*by)
        out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
        written = spark.read.schema(df.schema).parquet(path)
        ranges = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min(q(keys[0])).alias("low"), F.max(q(keys[0])).alias("high"), F.count(F.lit(1)).alias("rows"),
            F.max(q(keys[0]).isNull()).alias("nulls"),
        )
        ranges.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{FILES}")  # a row for each file
        fs, where = _fs(spark, staged)
        fs.delete(where, True)
        return RunReport(path, int(obs.get["rows"]), seconds())


def _file_plan(pieces: list[tuple[str, int, int]], file_bytes: int) -> tuple[list[tuple[str, int, int, int]], int]:
    """For each piece (name, bytes, rows) its first file, how many files it is cut into and its
    rows; and the number of files."""
    plan, number, filled = [], -1, file_bytes
    for name, size, n in pieces:
        if not n:
            continue
        cuts = min(max(1, round(size / file_bytes)), n)
        if cuts > 1 or filled + size / 2 > file_bytes:  # the nearer of too much and too little
            number, filled = number + 1, 0
        plan.append((name, number, cuts, n))
        number += cuts - 1
        filled = filled + size if cuts == 1 else file_bytes
    return plan, number + 1


def _holds_map(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (MapType, VariantType))


def files_of(spark: SparkSession, path: str, low=None, high=None) -> list[str]:
    """The data files of a clustered write that may hold keys from ``low`` to ``high``."""
    ranges = spark.read.parquet(f"{path.rstrip('/')}/{FILES}")
    if low is not None:
        ranges = ranges.where(F.col("high") >= F.lit(low))
    if high is not None:
        ranges = ranges.where(F.col("low") <= F.lit(high))
    return [f"{path.rstrip('/')}/{r['file']}" for r in ranges.select("file").collect()]


def read_clustered(spark: SparkSession, path: str, key: str, low=None, high=None) -> DataFrame:
    """The rows of a clustered write with ``low`` <= ``key`` <= ``high`` (None: no border; null keys
    are outside any border), reading only files whose range meets it."""
    whole = spark.read.parquet(path)
    if low is None and high is None:
        return whole
    files = files_of(spark, path, low, high)
    rows = spark.read.schema(whole.schema).parquet(*files) if files else whole.where(F.lit(False))
    if low is not None:
        rows = rows.where(q(key) >= F.lit(low))
    return rows if high is None else rows.where(q(key) <= F.lit(high))


def persist(df: DataFrame, level: str | StorageLevel | None) -> DataFrame:
    """Persist at a named level (D3); None leaves the plan as it is."""
    if level is None:
        return df
    lvl = LEVELS[level] if isinstance(level, str) else level
    return df.persist(lvl)
