"""Row-local summaries of nested lists: sizes and exact money sums.

Used to compare documents with flat SQL and to report on them. Everything is a
higher-order expression on the row (``size``, ``aggregate``), so summarising a
document adds no shuffle. A null list stays null; money is summed as
DECIMAL(38,2) (order-independent) and returned as double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"
ITEM_MONEY = "decimal(18,2)"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def list_size(col: str | Column) -> Column:
    c = _c(col)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.size(c)).cast("bigint")


def _money_dec(col: Column, field: str) -> Column:
    zero = F.lit(0).cast(MONEY)
    return F.aggregate(col, zero, lambda acc, x: (acc + F.coalesce(x[field].cast(ITEM_MONEY), F.lit(0))).cast(MONEY))


def list_money(col: str | Column, field: str) -> Column:
    """Sum of ``field`` over the list's items, null for a null list."""
    return _money_dec(_c(col), field).cast("double")


def nested_size(col: str | Column, inner: str) -> Column:
    """Total items of the inner list ``inner`` over the outer list's items."""
    return F.aggregate(
        _c(col), F.lit(0).cast("bigint"), lambda acc, x: acc + F.coalesce(F.size(x[inner]), F.lit(0)).cast("bigint")
    )


def nested_money(col: str | Column, inner: str, field: str) -> Column:
    zero = F.lit(0).cast(MONEY)
    return F.aggregate(
        _c(col),
        zero,
        lambda acc, x: (acc + F.coalesce(_money_dec(x[inner], field), zero)).cast(MONEY),
    ).cast("double")


def count_where(col: str | Column, pred) -> Column:
    """Number of items of the list for which ``pred(item)`` holds."""
    return F.aggregate(
        _c(col), F.lit(0).cast("bigint"), lambda acc, x: acc + F.when(pred(x), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    )
