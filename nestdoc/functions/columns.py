"""Column helpers: projections, packing and renames.

All of them are plain projections: Catalyst folds them into the scan's
column list, so unused input columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def q(name: str, side: str | None = None) -> Column:
    """A column by exact name, quoted so that dots or spaces stay literal."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{side}.{quoted}" if side else quoted)


def all_except(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """Column names of ``df`` in order, without the excluded ones."""
    drop = set([exclude] if isinstance(exclude, str) else exclude)
    return [c for c in df.columns if c not in drop]


def project_all_except(df: DataFrame, exclude: Iterable[str]) -> DataFrame:
    return df.select(*[q(c) for c in all_except(df, exclude)])


def pack(df: DataFrame, out: str, cols: Sequence[str] | None = None, *, exclude: Iterable[str] = ()) -> DataFrame:
    """Add a struct column ``out`` holding ``cols`` (default: all but ``exclude``) (P5).

    Field order inside the struct is the column order.
    """
    fields = list(cols) if cols is not None else all_except(df, exclude)
    return df.withColumn(out, F.struct(*[q(c) for c in fields]))


def unpack(df: DataFrame, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Select the fields of a struct column back as columns."""
    return df.select(*[q(c) for c in keep], q(col).alias("_packed")).select(*[q(c) for c in keep], "_packed.*")


def rename_one(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename one column; a name that is absent changes nothing."""
    return df.withColumnRenamed(old, new)


def rename_suffix(df: DataFrame, cols: Iterable[str] | None = None, suffix: str = "_n") -> DataFrame:
    """Append ``suffix`` to all columns, or to the listed ones that exist."""
    names = df.columns if cols is None else [c for c in cols if c in df.columns]
    return df.withColumnsRenamed({c: c + suffix for c in names})
