"""Numbers made from keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def integer_in_range(col: str | Column, low: int, high: int) -> Column:
    """An integer from ``low`` to ``high``, both included, that follows ``col`` round and round."""
    return F.lit(low).cast("long") + F.pmod(_c(col), F.lit(high - low + 1))


def key_offset(col: str | Column, offset: int) -> Column:
    """The key ``offset`` places on."""
    return _c(col) + F.lit(offset).cast("long")
