"""``join_split``: an equi-join that returns matched rows and/or unmatched rows.

Modes (number or name):

==  ===============  ==========================================================
1   ``inner``        matched rows, chosen columns
2   ``inner_left``   (matched, left rows without a match)
3   ``inner_both``   (matched, left without match, right without match)
4   ``inner_right``  (matched, right rows without a match)
5   ``left_anti``    left rows without a match, all left columns
6   ``right_anti``   right rows without a match, all right columns
7   ``left``         left outer join, chosen columns
==  ===============  ==========================================================

Only the joins the mode returns are planned. Unmatched parts are Spark
``left_anti`` joins (NOT EXISTS semantics): a null key never matches, so rows
with a null key land in the unmatched parts. Duplicate keys multiply rows.
The join strategy is Spark's (size-based broadcast, sort-merge, adaptive
skew splitting); nothing is forced here.

``skew=Skew(...)`` is for keys that hold a mass of rows. Adaptive execution
splits only the preserved side of a left or right join and no side of a full
one. Here the hot keys of both sides are measured (a sketch, then exact counts
of the candidates), and each hot key is dealt over a grid of cells: its left
rows by their number to one row of the grid and as copies to all its columns,
its right rows the other way round. Every pair of rows meets in one cell, and
no cell holds more than ``rows`` rows of a side. As the counts tell which hot
keys occur on both sides, a row that finds nobody in one of its cells is told
from a row without any match. Null keys, which never match, are not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q
from .heavy import COUNT, heavy_keys
from .nest import small_keys

MODES = {
    1: "inner",
    2: "inner_left",
    3: "inner_both",
    4: "inner_right",
    5: "left_anti",
    6: "right_anti",
    7: "left",
}
_BY_NAME = {v: k for k, v in MODES.items()}


class JoinParts(NamedTuple):
    """Parts of a split join; a part the mode does not ask for is None."""

    matched: DataFrame | None = None
    left_only: DataFrame | None = None
    right_only: DataFrame | None = None


@dataclass(frozen=True)
class Skew:
    """Keys with more than ``rows`` rows on a side are dealt over cells of at most that many.

    ``stable``: both sides are file scans (or give the same partitions and row
    order whenever they are read). Otherwise the hot rows, and they alone, are
    written as a reliable checkpoint before they are numbered.
    """

    rows: int = 1_000_000
    stable: bool = False


def mode_number(mode: int | str) -> int:
    if isinstance(mode, bool):
        raise ValueError(f"join mode must be 1-7 or one of {sorted(_BY_NAME)}, got {mode!r}")
    if isinstance(mode, int):
        if mode not in MODES:
            raise ValueError(f"join mode must be 1-7, got {mode}")
        return mode
    if mode not in _BY_NAME:
        raise ValueError(f"join mode must be 1-7 or one of {sorted(_BY_NAME)}, got {mode!r}")
    return _BY_NAME[mode]


def _condition(on: str | Column | Sequence[str] | Sequence[Column]):
    """Names stay a USING list; conditions are ANDed into one Column."""
    if isinstance(on, (str, Column)):
        on = [on]
    on = list(on)
    if not on:
        raise ValueError("empty join key")
    if all(isinstance(k, str) for k in on):
        return on, on
    if all(isinstance(k, Column) for k in on):
        return reduce(lambda a, b: a & b, on), []
    raise ValueError("join key must be all names or all conditions")


def _pick(df: DataFrame, cols, skip: Sequence[str] = ()) -> list[str]:
    if cols is None:
        return []
    if cols == "*":
        return [c for c in df.columns if c not in skip]
    return [cols] if isinstance(cols, str) else list(cols)


_L, _R = "_l", "_r"  # a side's columns as a struct, null where the side has no row


def _sided(df: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str) -> DataFrame:
    row = F.struct(F.lit(True).alias("_in"), *[q(c) for c in cols])
    return df.select(*[q(k) for k in keys], row.alias(name))


def _hot_grid(left: DataFrame, right: DataFrame, keys: list[str], skew: Skew) -> DataFrame | None:
    """The hot keys of either side with the number of cells for the left (``_sl``) and right rows
    (``_sr``) and whether both sides have the key; None if there are none."""
    found = [h for side in (left, right) if (h := heavy_keys(side, keys, skew.rows, nulls=False)) is not None]
    if not found:
        return None
    names = [q(k) for k in keys]
    hot = reduce(DataFrame.unionByName, [h.select(*names) for h in found]).distinct()
    hot = small_keys(hot.checkpoint(eager=True), keys)[0]
    for side, name in ((left, "_nl"), (right, "_nr")):
        counts = side.select(*names).join(hot, keys, "left_semi").groupBy(*names).agg(F.count(F.lit(1)).alias(name))
        hot = hot.join(counts, keys, "left")
    n = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("_nl", "_nr")}
    cells = [F.greatest(F.ceil(n[c] / skew.rows), F.lit(1)).cast("int").alias(out) for c, out in (("_nl", "_sl"), ("_nr", "_sr"))]
    grid = hot.select(*names, *cells, ((n["_nl"] > 0) & (n["_nr"] > 0)).alias("_both")).checkpoint(eager=True)
    return small_keys(grid, keys)[0]


def _dealt(df: DataFrame, keys: list[str], grid: DataFrame, mine: str, other: str, flag: str, skew: Skew) -> DataFrame:
    """Rows with their cell: (mine, other) are the names of the side's own cell column and of the
    one it is copied over. Rows of other keys are in cell (0, 0)."""
    names = [q(c) for c in df.columns]
    zero = F.lit(0)
    cold = df.join(grid, keys, "left_anti").select(*names, zero.alias(mine), zero.alias(other), F.lit(False).alias(flag))
    cells = {"_a": "_sl", "_b": "_sr"}
    hot = df.join(grid, keys).select(*names, "_sl", "_sr", "_both")
    if not skew.stable:
        hot = hot.checkpoint(eager=True)
    hot = hot.withColumn(mine, F.pmod(F.monotonically_increasing_id(), q(cells[mine])).cast("int"))
    copies = F.explode(F.sequence(zero, q(cells[other]) - 1))
    return cold.unionByName(hot.select(*names, q(mine), copies.alias(other), F.col("_both").alias(flag)))


def _skew_join(a: DataFrame, b: DataFrame, keys: list[str], how: str, skew: Skew) -> DataFrame:
    """``a.join(b, keys, how)`` of two frames of keys and one struct column each."""
    null_key = reduce(lambda x, y: x | y, [q(k).isNull() for k in keys])
    grid = _hot_grid(a, b, keys, skew)
    x, y = a.where(~null_key), b.where(~null_key)
    if grid is None:
        out = x.join(y, keys, how)
    else:
        x = _dealt(x, keys, grid, "_a", "_b", "_fl", skew)
        y = _dealt(y, keys, grid, "_b", "_a", "_fr", skew)
        out = x.join(y, [*keys, "_a", "_b"], how)
        # copies of a key that both sides have match elsewhere, if not here
        spurious = (F.col(_L).isNull() & F.col("_fr")) | (F.col(_R).isNull() & F.col("_fl"))
        out = out.where(~F.coalesce(spurious, F.lit(False)))
    out = out.select(*[q(k) for k in keys], _L, _R)
    types = dict(zip(out.columns, [f.dataType for f in out.schema.fields], strict=True))

    def alone(side: DataFrame, mine: str, other: str) -> DataFrame:
        rows = side.where(null_key)
        return rows.select(*[q(k).cast(types[k]).alias(k) for k in keys], q(mine), F.lit(None).cast(types[other]).alias(other)).select(out.columns)

    if how in ("left", "full"):
        out = out.unionByName(alone(a, _L, _R))
    if how in ("right", "full"):
        out = out.unionByName(alone(b, _R, _L))
    return out


def join_split(
    left: DataFrame,
    right: DataFrame,
    on,
    left_cols="*",
    right_cols=None,
    mode: int | str = "inner",
    skew: Skew | None = None,
):
    """Join ``left`` and ``right`` on ``on`` and return what ``mode`` asks for.

    ``on`` is a name, a list of names (equal names on both sides, USING), or a
    list of Column conditions that are ANDed. ``left_cols`` / ``right_cols`` are
    ``"*"``, a list of names, or (right only) None for no right columns; a left
    row matching n right rows stays n times. With a USING key, ``"*"`` on the
    right leaves the key out, so it appears once.

    Modes 1, 5, 6, 7 return one DataFrame; modes 2, 3, 4 a :class:`JoinParts`.

    ``skew`` deals hot keys over several tasks (key names only): the matched
    rows of modes 1 to 4 and 7. Unmatched parts look up distinct keys, which
    adaptive execution splits on the side that is kept.
    """
    m = mode_number(mode)
    cond, using = _condition(on)
    if skew and not using:
        raise ValueError("skew needs key names")

    def matched(how: str) -> DataFrame:
        if skew:
            lc, rc = _pick(left, left_cols), _pick(right, right_cols, skip=using)
            both = _skew_join(_sided(left, using, lc, _L), _sided(right, using, rc, _R), using, how, skew)
            return both.select(*[q(_L)[c].alias(c) for c in lc], *[q(_R)[c].alias(c) for c in rc])
        a, b = left.alias("_l"), right.alias("_r")
        cols = [q(c, "_l") for c in _pick(left, left_cols)]
        cols += [q(c, "_r") for c in _pick(right, right_cols, skip=using)]
        return a.join(b, on=cond, how=how).select(*cols)

    def keys_of(side: DataFrame) -> DataFrame:
        return side.select(*[q(k) for k in using]).distinct() if skew else side

    def left_only() -> DataFrame:
        return left.join(keys_of(right), on=cond, how="left_anti")

    def right_only() -> DataFrame:
        return right.join(keys_of(left), on=cond, how="left_anti")

    if m == 1:
        return matched("inner")
    if m == 2:
        return JoinParts(matched("inner"), left_only(), None)
    if m == 3:
        return JoinParts(matched("inner"), left_only(), right_only())
    if m == 4:
        return JoinParts(matched("inner"), None, right_only())
    if m == 5:
        return left_only()
    if m == 6:
        return right_only()
    return matched("left")


PART = "part"


def join_tagged(
    left: DataFrame, right: DataFrame, on, left_cols="*", right_cols=None, mode: int | str = 3, skew: Skew | None = None
) -> DataFrame:
    """The parts of modes 2, 3 and 4 as one frame with a column ``part`` (matched, left_only,
    right_only), from one outer join: each side is read and shuffled once for all parts.

    ``on`` is a name or names, or conditions as in :func:`join_split` (at least
    one equality among them keeps the join a hash or merge join). With names
    the keys come first and once; with conditions the chosen columns of both
    sides. Rows of a side alone have nulls in the other side's columns; a row
    with a null key, or for which a condition is not true, matches nothing.
    """
    m = mode_number(mode)
    if m not in (2, 3, 4):
        raise ValueError(f"only modes 2, 3 and 4 have parts, got {mode!r}")
    cond, keys = _condition(on)
    if skew and not keys:
        raise ValueError("skew needs key names")
    kept, others = _pick(left, left_cols), _pick(right, right_cols, skip=keys)
    clash = sorted((set(kept) | set(keys)) & set(others))
    if clash:
        raise ValueError(f"both sides have columns {clash}; rename or drop them")
    how = {2: "left", 3: "full", 4: "right"}[m]
    if not keys:
        # Markers tell a row that is not there from a row of nulls. The sides keep all their
        # columns, which the conditions are about; what is not used is not read.
        a, b = left.withColumn("_in_l", F.lit(True)), right.withColumn("_in_r", F.lit(True))
        both = a.alias("_l").join(b.alias("_r"), cond, how)
        no_left, no_right = F.col("_l._in_l").isNull(), F.col("_r._in_r").isNull()
        columns = [q(c, "_l").alias(c) for c in kept] + [q(c, "_r").alias(c) for c in others]
    else:
        kept = [c for c in kept if c not in keys]
        a, b = _sided(left, keys, kept, _L), _sided(right, keys, others, _R)
        both = _skew_join(a, b, keys, how, skew) if skew else a.join(b, keys, how)
        no_left, no_right = F.col(_L).isNull(), F.col(_R).isNull()
        columns = [*[q(k) for k in keys], *[q(_L)[c].alias(c) for c in kept], *[q(_R)[c].alias(c) for c in others]]
    part = F.when(no_left, "right_only").when(no_right, "left_only").otherwise("matched")
    return both.select(part.alias(PART), *columns)
