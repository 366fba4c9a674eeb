"""Heavy keys: the keys of a table that hold more than a given number of its rows.

One pass fills a mergeable frequent-items sketch per task (Spark's
``approx_top_k_accumulate`` over a 64-bit hash of the key columns), the sketches
meet in two steps, and only where it names a candidate are rows counted
exactly, the candidates' rows alone. So a table without a heavy key costs a
scan of its key columns and no shuffle of them: what moves is one sketch of
bounded size for each task.

The sketch is trusted only where its error bound allows: with N rows, M slots
and a bound of n rows, a key of over n rows cannot be missing while
2 * 3.5 N / M < n. Beyond (more than about M / 7 keys could be heavy) all
keys are counted by a plain aggregation, so the result never depends on the way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q

#: Items that a sketch tracks; its map has the next power of two over 4/3 of them.
TRACKED = 1 << 16
#: Tasks that put the sketches of a table together before the last one does.
MERGERS = 64
#: Candidates that are written into a filter.
LITERALS = 100
#: Column with the rows of a heavy key.
COUNT = "_n"


def _slots(tracked: int) -> int:
    slots = 1
    while slots < tracked / 0.75:
        slots *= 2
    return slots


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[q(k) for k in keys])


def _with_hash_in(rows: DataFrame, keys: Sequence[str], hashes: Sequence[int]) -> DataFrame:
    """The rows whose key has one of the hashes: a set inside the scan's own filter, or, where
    there are many, a table sent to the tasks (at most slots / 2 numbers). No row is shuffled."""
    if len(hashes) <= LITERALS:
        return rows.where(_hash(keys).isin(list(hashes)))
    few = rows.sparkSession.createDataFrame([(h,) for h in hashes], "_h long")
    return rows.join(F.broadcast(few), _hash(keys) == F.col("_h"), "left_semi")


@dataclass(frozen=True)
class Sketched:
    """What one pass over the keys of a table tells: its rows, a bound on the rows of any key,
    whether the sketch can miss no heavy key, and the hashes of the candidates."""

    rows: int
    most: int
    sure: bool
    candidates: tuple[int, ...]


def sketch(frames: Sequence[tuple[DataFrame, Sequence[str]]], most: int, tracked: int = TRACKED) -> list[Sketched]:
    """A sketch of each table's key columns, all in one job. Candidates are the key hashes that
    may hold more than ``most`` rows; there are fewer than slots / 2 of them in a table."""
    if not frames:
        return []
    parts = []
    for i, (df, keys) in enumerate(frames):
        hashed = df.select(_hash(keys).alias("h"), F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("m"))
        part = hashed.groupBy("m").agg(
            F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("s")
        )
        parts.append(part.select(F.lit(i).alias("i"), "rows", "s"))
    one = reduce(DataFrame.unionByName, parts).groupBy("i").agg(
        F.sum("rows").alias("rows"), F.expr(f"approx_top_k_combine(s, {tracked})").alias("s")
    )
    slots = _slots(tracked)
    # a map that was never full counts exactly
    error = F.when(F.col("rows") <= slots // 2, 0).otherwise(F.col("rows") * (3.5 / slots))
    found = one.select("i", "rows", F.expr(f"approx_top_k_estimate(s, {tracked})").alias("top")).select(
        "i", "rows", F.array_max(F.col("top.count")).alias("most"),
        F.transform(F.filter("top", lambda x: x["count"] + error > most), lambda x: x["item"]).alias("items"),
    )
    out = [Sketched(0, 0, True, ())] * len(frames)
    for r in found.collect():  # one row for each table; its candidates are bounded by the sketch
        slack = 0 if r["rows"] <= slots // 2 else int(3.5 * r["rows"] / slots) + 1
        sure = r["rows"] <= most or 2 * slack < most or not slack
        # a key that the sketch does not list has at most two errors' worth of rows
        out[r["i"]] = Sketched(r["rows"], max(r["most"] or 0, slack) + slack, sure, tuple(r["items"] or ()))
    return out


def heavy_keys(
    df: DataFrame, keys: Sequence[str], most: int, *, nulls: bool = True, tracked: int = TRACKED, sketched: Sketched | None = None
) -> DataFrame | None:
    """The keys of ``df`` with more than ``most`` rows and their number of rows (``_n``), or None
    when the sketch shows that there is none. A null key is a key unless ``nulls`` is False.

    ``sketched`` passes a sketch of the same keys that was made with others.
    """
    rows = df.select(*[q(k) for k in keys])
    if not nulls:
        rows = rows.where(reduce(lambda a, b: a & b, [q(k).isNotNull() for k in keys]))
    if sketched is None:
        sketched = sketch([(rows, keys)], most, tracked)[0]
    if sketched.rows <= most:
        return None
    if sketched.sure:
        if not sketched.candidates:
            return None
        rows = _with_hash_in(rows, keys, sketched.candidates)
    return rows.groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias(COUNT)).where(F.col(COUNT) > most)
