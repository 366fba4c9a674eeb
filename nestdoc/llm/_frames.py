"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestdoc.session import ensure_checkpoint_dir

#: Words `[^\x20\x09-\x0D]+` as a Java pattern.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pinned(df: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder and read from there: it is computed
    once, and its files outlive any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(*frames: DataFrame) -> None:
    """Delete the checkpoint files of pinned frames (or of columns selected from them) that nothing
    reads any more: frames made from them must be pinned themselves. Shuffle files of steps that are
    over go as well, as soon as the driver's collector has found that nothing refers to them; it is
    asked to look now, for a driver with memory to spare would keep them all until the job ends."""
    sc = None
    for df in frames:
        plan = df._jdf.queryExecution().analyzed()
        while plan.getClass().getSimpleName() == "Project":
            plan = plan.child()
        if plan.getClass().getSimpleName() != "LogicalRDD":
            continue
        file = plan.rdd().getCheckpointFile()
        if file.isDefined():
            sc = df.sparkSession.sparkContext
            path = sc._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    if sc is not None:
        gc.collect()  # Python's references to finished plans hold the JVM's
        sc._jvm.System.gc()


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores in front until no column is called so in any letter case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def quoted(name: str) -> Column:
    """A column by its literal name: dots and blanks in it are no syntax."""
    return F.col("`" + name.replace("`", "``") + "`")


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(*cols: Column) -> Column:
    """A number from 0 to below 1 drawn from the columns' values: alike on every run."""
    bits = F.xxhash64(*cols)
    return F.shiftrightunsigned(bits, 11).cast("double") / F.lit(float(1 << 53))


#: Rows of a table of keys that is sent to every task.
MOST_SENT = 1_000_000


def sent(keys: DataFrame, most: int = MOST_SENT) -> DataFrame:
    """A narrow table, marked to be sent to every task if it has few rows; else it is joined by a
    shuffle."""
    return F.broadcast(keys) if keys.limit(most + 1).count() <= most else keys


#: Keys of 8 bytes that are sent to every Python task.
MOST_KEYS = 1 << 22


def gathered(keys: DataFrame, most: int = MOST_KEYS) -> Broadcast | None:
    """The values of a frame of one column of longs, sorted, for every Python task; None if there are
    more than `most`. They cross the driver as 8 bytes each, where a row of a table that is sent takes
    over 100 in its heap and more while it is built."""
    own = pinned(keys.toDF("key"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).to_numpy().tobytes()], pa.binary())], names=["packed"])

    few = own.count() <= most
    parts = [r["packed"] for r in own.mapInArrow(pack, "packed binary").collect()] if few else []
    release(own)
    values = np.unique(np.frombuffer(b"".join(parts), np.int64))
    return keys.sparkSession.sparkContext.broadcast(values) if few else None


def is_among(values: np.ndarray, some: pa.Array) -> np.ndarray:
    """Which of some longs are in the sorted values."""
    own = some.to_numpy(zero_copy_only=False)
    if not len(values):
        return np.zeros(len(own), bool)
    return values[np.minimum(np.searchsorted(values, own), len(values) - 1)] == own


def parted(docs: DataFrame, key: Column, keys: DataFrame, most: int = MOST_KEYS) -> tuple[DataFrame, DataFrame]:
    """The rows of `docs` whose key, a 64-bit hash, is in the one column of `keys`, and the others.
    Only the keys cross to Python; rows do not move unless there are more than `most` keys."""
    held = gathered(keys, most)
    if held is None:
        name = free_name(docs, "part_key")
        keys = keys.toDF(name)
        return tuple(docs.join(keys, key == F.col(name), how) for how in ("left_semi", "left_anti"))

    @F.arrow_udf("boolean")
    def found(k: pa.Array) -> pa.Array:
        return pa.array(is_among(held.value, k))

    if not len(held.value):
        return docs.where(F.lit(False)), docs
    return docs.where(found(key)), docs.where(~found(key))


def widened(
    docs: DataFrame,
    text: str,
    new: list[tuple[str, T.DataType]],
    read: Callable[[Iterator[pa.RecordBatch], int], Iterator[tuple[pa.RecordBatch, list[pa.Array]]]],
) -> DataFrame:
    """`docs` plus columns that `read` computes from its batches and the place of column `text`.

    Columns cross to Python as c0, c1, ..., so names with dots or names that the new columns
    have too do no harm; a new name that is taken gets underscores in front."""
    old = [f"c{k}" for k in range(len(docs.columns))]
    names = list(docs.columns)
    added = []
    for k, (name, kind) in enumerate(new):
        taken = {c.lower() for c in names}
        while name.lower() in taken:
            name = f"_{name}"
        names.append(name)
        added.append(T.StructField(f"n{k}", kind))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, columns in read(batches, at):
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*old, *(f.name for f in added)])

    fields = [T.StructField(n, f.dataType) for n, f in zip(old, docs.schema.fields, strict=True)]
    return docs.toDF(*old).mapInArrow(run, T.StructType([*fields, *added])).toDF(*names)
