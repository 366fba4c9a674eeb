"""Date helpers for dates kept as ``yyyy-MM-dd`` text.

ISO text sorts as the dates do, so comparisons on the text are safe. The
open-ended marks are text too: year 9999 does not fit every engine's
timestamp, while DATE holds it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: open-ended date marks ------------------------------------
OPEN_END = "9999-12-31"
OPEN_START = "0001-01-01"
# ------------------------------------------------------------------------------

DAY_FMT = "yyyy-MM-dd"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_text(col: str | Column) -> Column:
    """A date or timestamp as ``yyyy-MM-dd`` text."""
    return F.date_format(_c(col), DAY_FMT)


def is_open(col: str | Column) -> Column:
    """True where the date text is the open end mark."""
    return _c(col) == F.lit(OPEN_END)


def is_open_start(col: str | Column) -> Column:
    return _c(col) == F.lit(OPEN_START)


def to_day(col: str | Column) -> Column:
    """Typed view of a date text (DATE holds 9999-12-31)."""
    return F.to_date(_c(col), DAY_FMT)


def day_before(col: str | Column) -> Column:
    """The day before, as text."""
    return as_text(F.date_sub(F.to_date(_c(col)), 1))


def open_or(cond: Column, value: Column) -> Column:
    """``value`` where ``cond`` holds, else the open end mark."""
    return F.when(cond, value).otherwise(F.lit(OPEN_END))


def run_date_columns(as_of: str | _dt.date | None = None) -> dict[str, Column]:
    """Run date, year of run and day before run.

    ``as_of`` fixes the run date so that results repeat; None takes today.
    """
    if as_of is None:
        day = F.current_date()
    else:
        day = F.to_date(F.lit(str(as_of)))
    return {
        "run_date": as_text(day),
        "run_year": F.year(day).cast("bigint"),
        "run_day_before": as_text(F.date_sub(day, 1)),
    }


def days_between(start: str | _dt.date, end: str | _dt.date) -> int:
    """Number of calendar days in [start, end], both included."""
    s, e = _dt.date.fromisoformat(str(start)), _dt.date.fromisoformat(str(end))
    return (e - s).days + 1


def day_in_range(start: str | Column, span: Column) -> Column:
    """``start`` plus ``span`` days, as text (F6). ``start`` is a text or column."""
    base = F.to_date(F.lit(start)) if isinstance(start, str) else F.to_date(start)
    return as_text(F.date_add(base, span.cast("int")))
