"""Text helpers (F1-F4, F8): slicing, cleaning, formatting, choosing from a list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Account number parts as 1-based (start, length); the control part is three
# characters long and the contract takes the rest (length None).
ACCOUNT_PARTS = (
    ("empresa", 5, 4),
    ("oficina", 9, 4),
    ("digcontrol", 13, 3),
    ("contrato", 16, None),
)


def slice_text(col: str | Column, start: int, length: int | None = None) -> Column:
    c = _c(col)
    if length is None:
        return F.substring(c, start, 2**31 - 1)
    return F.substring(c, start, length)


def split_account(col: str | Column) -> dict[str, Column]:
    """The four parts cut from an account number (F1)."""
    return {name: slice_text(col, s, n) for name, s, n in ACCOUNT_PARTS}


def clean_text(col: str | Column, upper: bool = False) -> Column:
    """Commas become ';' and newlines a blank, so the text fits one CSV field (F2);
    ``upper`` also upper-cases it (F3)."""
    out = F.translate(_c(col), ",\n", "; ")
    return F.upper(out) if upper else out


def join_text(sep: str, *cols: str | Column) -> Column:
    """Fields joined with ``sep``."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def pick(choices: Sequence[str], index: Column) -> Column:
    """``choices[index mod len]`` (F8): a fixed list indexed by a number."""
    arr = F.array(*[F.lit(x) for x in choices])
    return F.element_at(arr, (F.pmod(index, F.lit(len(choices))) + 1).cast("int"))
