"""``nest``: fold child rows into one list of structs per key (A1-A4).

The default form is one hash exchange on the key, then one aggregation::

    df.repartition(key).groupBy(key).agg(sort_array(collect_list(struct(rest...))))

A map-side partial ``collect_list`` cuts no bytes (a list holds every row it
got) and builds per-key object buffers in the map tasks, so the rows are
shuffled as they are (compact unsafe rows) and folded once on the reduce side;
measured about twice as fast as the partial form. The result comes out
hash-partitioned by the key, so a later join on that key does not shuffle it
again. ``shuffle_first=False`` gives the plain partial + final aggregation
(useful when the input is already partitioned by the key).

Semantics: every column but the key goes into the struct, in column order; a
null key forms its own group (which then never matches a join); duplicates are
kept; a struct of nulls is kept. Lists are sorted by all their fields (or by
``order_by``) so a result is the same on every run and every partitioning.

Heavy keys: a list is one value in one row, so without a bound one key's
children all meet in one task. ``max_items=n`` bounds that: the output gets a
``page`` column and every list holds at most n items. The rows of a key with
more than n children are given a running number without being gathered
(numbered within each input partition, then offset by the counts of the
partitions before), and page = number div n. Identical copies spread like
any other rows. Items are sorted within a page; which items share a page
follows the input's partitions, not the sort order, unless
``ordered_pages=True``: the heavy keys' rows are then range-sorted first
(ties broken by input place), so page p holds the p-th run of the sorted
list and positions in the whole list are page * max_items + place in page.

Where a list is short enough for one task, :func:`cut_pages` gives the same
pages at no shuffle: the list is gathered whole and cut in its own row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, MapType, NumericType, StructType, TimestampNTZType, TimestampType, VariantType,
)

from ..functions.columns import q
from .heavy import heavy_keys as find_heavy

PAGE = "page"
# Heavy keys are at most rows / max_items by count; they are broadcast to the
# rows only when their measured number is under this bound and their bytes
# (twice their JSON text) under the byte budget.
HOT_KEYS_BROADCAST_LIMIT = 1_000_000
HOT_KEYS_BROADCAST_BYTES = 256 * 1024 * 1024
# bytes a fixed-width key takes at most as JSON text (a decimal(38) is 40 characters)
_FIXED_KEY_BYTES = 48


_FIXED_WIDTH = (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)


def _as_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _comparator(order_by: Sequence[str]):
    """array_sort comparator on some fields, nulls first."""

    def cmp(a: Column, b: Column) -> Column:
        result = F.lit(0)
        for f in reversed(list(order_by)):
            x, y = a[f], b[f]
            result = (
                F.when(x.isNull() & y.isNull(), result)
                .when(x.isNull(), F.lit(-1))
                .when(y.isNull(), F.lit(1))
                .when(x < y, F.lit(-1))
                .when(x > y, F.lit(1))
                .otherwise(result)
            )
        return result

    return cmp


def collect_sorted(
    item: Column, *, sort: bool = True, order_by: Sequence[str] | None = None, orderable: Sequence[str] | None = None
) -> Column:
    """collect_list of ``item``, sorted by all its fields, or by ``order_by`` and then all fields
    (so that ties fall alike on every run). ``orderable`` names the fields that have an order
    where some have none (maps): ties then fall by those alone."""
    if not sort:
        return F.collect_list(item)
    if not order_by:
        return F.sort_array(F.collect_list(item))
    if orderable is not None:
        by = [*order_by, *[c for c in orderable if c not in order_by]]
        return F.array_sort(F.collect_list(item), _comparator(by))
    lead = F.struct(*[q(c).alias(f"o{k}") for k, c in enumerate(order_by)])
    whole = F.sort_array(F.collect_list(F.struct(lead.alias("lead"), item.alias("item"))))
    return F.transform(whole, lambda x: x["item"])


def item_fields(df: DataFrame, keys: Iterable[str], exclude: Iterable[str] = (), cols: Sequence[str] | None = None) -> list[str]:
    if cols is not None:
        return list(cols)
    skip = set(keys) | set(exclude)
    return [c for c in df.columns if c not in skip]


def nest(
    df: DataFrame,
    key: str | Sequence[str],
    out: str,
    *,
    cols: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
    order_by: Sequence[str] | None = None,
    sort: bool = True,
    max_items: int | None = None,
    shuffle_first: bool = True,
    checkpoint: bool = True,
    key_counts_from: DataFrame | None = None,
    heavy_keys: int | None = None,
    ordered_pages: bool = False,
    weight: Column | None = None,
    hot_keys: DataFrame | None = None,
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Group ``df`` by ``key`` and collect the other columns as a list of structs.

    Returns ``(key..., out)``, or ``(key..., page, out)`` when ``max_items`` is set.

    The paged form first counts rows per key, on ``key_counts_from`` when
    given (any table with the key columns whose per-key counts are at least
    those of ``df``, such as the base table of a derived ``df``: cheap, as
    only its key columns are read) or else on ``df``; ``heavy_keys`` passes a
    count already made. Without a heavy key it is the plain nest with page 0.
    Otherwise it reads its input three more times (light keys, heavy keys,
    page numbers); with ``checkpoint=True`` the input is then written once to
    the session's checkpoint folder (a reliable checkpoint, which also cuts
    the lineage) so it is not recomputed for each read.

    ``ordered_pages=True`` makes a heavy key's pages follow the sort order:
    page p holds items p*max_items ... of the key's sorted list, so page
    number and place in the page give an item's position in the whole list.
    It costs one range sort of the heavy keys' rows, which spreads a heavy
    key over several tasks.

    ``weight`` (1 or more for each row, such as 1 + the items of its own lists)
    bounds what a page weighs instead of how many items it has: a row whose
    running weight, counted from the key's first row, passes a multiple of
    max_items opens the next page. A page then weighs less than max_items plus
    its last item; an item of more counts as max_items, so no page is left out.
    With weights the heavy keys are given: ``hot_keys`` holds the key columns
    and ``_n`` of those that weigh more than max_items, and may be given
    without weights too, in place of a count.

    ``cut`` turns rows ``(key..., out)`` into rows ``(key..., page, out)``, as
    :func:`cut_pages` does: ``hot_keys`` then names only the keys that are too
    heavy for one task, and all other lists are cut in place.
    """
    keys = _as_list(key)
    fields = item_fields(df, keys, exclude, cols)
    item = F.struct(*[q(c) for c in fields])
    plain = [c for c in fields if not _unorderable(df.schema[c].dataType)]
    collect = collect_sorted(
        item, sort=sort, order_by=order_by, orderable=plain if len(plain) < len(fields) else None
    ).alias(out)
    key_cols = [q(k) for k in keys]
    if max_items is None:
        if shuffle_first:
            df = df.repartition(*key_cols)
        return df.groupBy(*key_cols).agg(collect)
    if max_items < 1:
        raise ValueError("max_items must be at least 1")

    hot, saved = None, False
    if weight is not None and hot_keys is None and heavy_keys != 0:
        raise ValueError("pages by weight need hot_keys")
    if hot_keys is not None:
        hot, heavy_keys = small_keys(hot_keys, keys, heavy_keys)
    elif heavy_keys is None:
        if key_counts_from is None and checkpoint:
            # the count would compute df: write it once first, then count it
            df, saved = df.checkpoint(eager=True), True
        source = df if key_counts_from is None else key_counts_from
        hot, heavy_keys = _hot_keys(source.select(*key_cols), keys, max_items)
    if heavy_keys == 0:
        # no heavy key: one page per key, the plain nest
        lists = df.repartition(*key_cols).groupBy(*key_cols).agg(collect)
        return lists.select(*key_cols, F.lit(0).cast("bigint").alias(PAGE), out)
    if checkpoint and not saved:
        df = df.checkpoint(eager=True)
    if hot is None:
        # the number of heavy keys is known: it is the size check of the broadcast
        source = df if key_counts_from is None else key_counts_from
        hot, _ = _hot_keys(source.select(*key_cols), keys, max_items, known=heavy_keys)
    return _nest_paged(df, keys, fields, collect, out, max_items, order_by, hot, ordered_pages and sort, weight, cut)


def small_keys(hot: DataFrame, keys: Sequence[str], known: int | None = None) -> tuple[DataFrame, int]:
    """A table of keys, marked to be sent to every task if its number of rows (``known`` if counted
    already) and bytes are under the budgets; and its number of rows. Keys of fixed width are
    measured by their number."""
    key_text = F.octet_length(F.to_json(F.struct(*[q(k) for k in keys])))
    fixed = all(isinstance(hot.schema[k].dataType, _FIXED_WIDTH) for k in keys)
    if known is not None and fixed:
        n_hot, n_bytes = known, known * _FIXED_KEY_BYTES * len(keys)
    elif known is not None and known > HOT_KEYS_BROADCAST_LIMIT:
        n_hot, n_bytes = known, None
    else:
        got = hot.agg(F.count(F.lit(1)).alias("n"), F.sum(key_text).alias("b")).collect()[0]
        n_hot, n_bytes = got["n"], int(got["b"] or 0)
    small = n_hot <= HOT_KEYS_BROADCAST_LIMIT and n_bytes is not None and 2 * n_bytes <= HOT_KEYS_BROADCAST_BYTES
    return (F.broadcast(hot) if small else hot), n_hot


def _hot_keys(df: DataFrame, keys: list[str], max_items: int, known: int | None = None) -> tuple[DataFrame, int]:
    """Keys with more than max_items rows (a null key included), and how many.

    They are found by a sketch of the keys and counted exactly (see
    :mod:`.heavy`); without a heavy key no key is shuffled. Their number (at
    most rows / max_items) and bytes are the size check before the broadcast.
    When ``known`` already gives the number (counted on the same keys),
    fixed-width keys need no measuring job; other keys are measured.
    """
    if known is None:
        hot = find_heavy(df, keys, max_items)
        if hot is None:
            return df.limit(0).withColumn("_n", F.lit(0).cast("bigint")), 0
    else:
        counts = df.groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
        hot = counts.where(F.col("_n") > max_items)
    return small_keys(hot, keys, known)


def _unorderable(kind: DataType) -> bool:
    """Maps and variants, alone or inside, have no order."""
    if isinstance(kind, ArrayType):
        return _unorderable(kind.elementType)
    if isinstance(kind, StructType):
        return any(_unorderable(f.dataType) for f in kind.fields)
    return isinstance(kind, (MapType, VariantType))


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where null equals null (a null key can be heavy too)."""
    a, b = left.alias("_a"), right.alias("_b")
    cond = reduce(lambda x, y: x & y, [q(k, "_a").eqNullSafe(q(k, "_b")) for k in keys])
    extra = [q(c, "_b") for c in right.columns if c not in keys]
    return a.join(b, cond, how).select(*[q(c, "_a") for c in left.columns], *extra)


def _nest_paged(df, keys, fields, collect, out, max_items, order_by, hot_keys, ordered=False, weight=None, cut=None) -> DataFrame:
    key_cols = [q(k) for k in keys]
    if weight is not None:
        df = df.withColumn("_w", F.least(weight, F.lit(max_items)).cast("bigint"))
    # Where each row sits in the input: its partition and its place in it.
    # On a checkpointed input both are fixed, so retries and reruns agree.
    located = df.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row"))
    marked = _join_null_safe(located, hot_keys, keys, "left")

    cold = (
        marked.where(F.col("_n").isNull())
        .repartition(*key_cols)
        .groupBy(*key_cols)
        .agg(collect)
    )
    cold = cut(cold) if cut else cold.select(*key_cols, F.lit(0).cast("bigint").alias(PAGE), out)

    # Heavy keys: number each key's rows without gathering them. Rows are
    # numbered within (key, input partition), which is at most one input
    # partition of rows per task whatever the key holds (identical copies
    # included); each (key, partition) then adds the rows of the partitions
    # before it, from a small table of per-partition counts.
    hot = marked.where(F.col("_n").isNotNull()).drop("_n")
    if ordered:
        # Pages in sort order: a range sort on the key and the item fields
        # spreads a heavy key over several tasks (ties broken by the input
        # place, so identical copies spread too); rows are then located by
        # (range partition, place in it), which follows the sort order. The
        # borders of a range sort depend on a sample and on the columns that
        # are asked for, so the located rows are written once (a reliable
        # checkpoint) and both the rows and their counts are read from there.
        lead = list(order_by or [])
        by = [*lead, *[c for c in fields if c not in lead]]
        orderable = [c for c in by if not _unorderable(hot.schema[c].dataType)]
        by = [*key_cols, *[q(c) for c in orderable], F.col("_part"), F.col("_row")]
        rest = [q(c) for c in hot.columns if c not in ("_part", "_row")]
        hot = hot.orderBy(*by).select(
            *rest, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")
        ).checkpoint(eager=True)
    in_part = Window.partitionBy(*key_cols, F.col("_part")).orderBy("_row")
    if weight is None:
        hot = hot.withColumn("_local", F.row_number().over(in_part) - 1)
        sizes = hot.groupBy(*key_cols, "_part").agg(F.count(F.lit(1)).alias("_cnt"))
    else:
        earlier = in_part.rowsBetween(Window.unboundedPreceding, -1)
        hot = hot.withColumn("_local", F.coalesce(F.sum("_w").over(earlier), F.lit(0)))
        sizes = hot.groupBy(*key_cols, "_part").agg(F.sum("_w").alias("_cnt"))
    before = Window.partitionBy(*key_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*key_cols, "_part", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    hot = _join_null_safe(hot, offsets, [*keys, "_part"], "inner")
    # (a private name: the rows may carry a page field of their own lists)
    number = F.col("_off") + F.col("_local")
    hot = hot.withColumn("_number", number).withColumn("_page", F.expr(f"_number div {max_items}").cast("bigint"))
    # shuffled as rows and folded once, like the plain nest
    pieces = hot.drop("_number").repartition(*key_cols, "_page").groupBy(*key_cols, "_page").agg(collect)
    return cold.unionByName(pieces.select(*key_cols, F.col("_page").alias(PAGE), out))


def _page_starts(items: Column, weight: Callable[[Column], Column], max_items: int) -> Column:
    """Places in a list (from 0) where its pages by weight begin; none for a null list."""
    none = F.array().cast("array<int>")
    zero = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("place"), none.alias("starts"))
    most = F.lit(max_items).cast("bigint")

    def step(a: Column, x: Column) -> Column:
        opens = a["sum"] >= F.size(a["starts"]) * most
        return F.struct(
            (a["sum"] + F.least(weight(x), most)).alias("sum"), (a["place"] + 1).alias("place"),
            F.when(opens, F.concat(a["starts"], F.array(a["place"]))).otherwise(a["starts"]).alias("starts"),
        )

    return F.coalesce(F.aggregate(items, zero, step, lambda a: a["starts"]), none)


def cut_pages(
    df: DataFrame, lists: Mapping[str, Callable[[Column], Column] | None], max_items: int, short: Iterable[str] = ()
) -> DataFrame:
    """One row for each page of whole lists: the other columns, ``page``, and the lists.

    Row-local: pages of up to ``max_items`` items, or by the weight that the
    function given for a list returns for an item (see :func:`nest`), in the
    list's own order. Page p of a row holds page p of each of its lists, null
    where a list has no such page; a row without items has page 0. Lists named
    in ``short`` stay whole on page 0.
    """
    if max_items < 1:
        raise ValueError("max_items must be at least 1")
    whole = set(short)
    base = [q(c) for c in df.columns if c not in lists]
    if whole >= set(lists):
        return df.select(*base, F.lit(0).cast("bigint").alias(PAGE), *[q(c) for c in lists])
    # a column of its own, so that it is not worked out again for every page
    starts = {c: f"_starts{k}" for k, c in enumerate(lists) if c not in whole and lists[c] is not None}
    df = df.select("*", *[_page_starts(q(c), lists[c], max_items).alias(name) for c, name in starts.items()])

    def number(c: str) -> Column:
        if c in starts:
            return F.size(starts[c])
        return F.when(q(c).isNull(), 0).otherwise(((F.size(q(c)) + (max_items - 1)) / max_items).cast("int"))

    def page(c: str, p: Column) -> Column:
        if c in whole:
            return F.when(p == 0, q(c))
        if c not in starts:
            return F.when(p < number(c), F.slice(q(c), p * max_items + 1, F.lit(max_items)))
        at = F.col(starts[c])
        end = F.coalesce(F.get(at, p + 1), F.size(q(c)))
        return F.when(p < F.size(at), F.slice(q(c), F.get(at, p) + 1, end - F.get(at, p)))

    last = F.greatest(F.lit(1), *[number(c) for c in lists if c not in whole]) - 1
    pages = F.transform(
        F.sequence(F.lit(0), last), lambda p: F.struct(p.cast("bigint").alias(PAGE), *[page(c, p).alias(c) for c in lists])
    )
    return df.select(*base, F.inline(pages))


def unnest(
    df: DataFrame,
    col: str,
    *,
    outer: bool = True,
    position: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Explode a list of structs back to rows: kept columns + the struct's fields.

    ``outer=True`` keeps a row with null fields for a null or empty list.
    ``position`` names a 0-based position column.
    """
    keep = [c for c in df.columns if c != col] if keep is None else list(keep)
    if position:
        gen = F.posexplode_outer(q(col)) if outer else F.posexplode(q(col))
        exploded = df.select(*[q(c) for c in keep], gen.alias(position, "_item"))
        return exploded.select(*[q(c) for c in keep], q(position), "_item.*")
    gen = F.explode_outer(q(col)) if outer else F.explode(q(col))
    exploded = df.select(*[q(c) for c in keep], gen.alias("_item"))
    return exploded.select(*[q(c) for c in keep], "_item.*")
