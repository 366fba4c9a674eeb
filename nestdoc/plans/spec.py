"""Declarative document specs and the one recursive builder (C1-C8 as data).

A :class:`DocSpec` names a table, its key, the child tables to fold in as lists
(:class:`Child`) and the parent-like tables whose columns are copied in
(:class:`Lookup`). :func:`build` turns a spec into joins and nests following
one rule: **nest every child before joining it**. A parent therefore never
fans out into the product of its children; each join is one-to-one on the key,
and each nested side arrives hash-partitioned by that key, so only the parent
side is shuffled for it.

With a bound (``BuildOptions.max_items``) the lists come in pages, where an
item weighs 1 and all that its own lists hold. A list that one task can gather
(``gather_items``) is built by the plain plan above and cut into its pages in
its own row, at no shuffle more. Beyond that parents are **split by their
key**: a key is heavy when one of its lists weighs more than both numbers.
Light parents keep the plain plan, over the light rows of every table; heavy
ones alone take the page plan, which spreads a list over tasks, over their own
rows; the two meet in a union. So a single heavy policy costs the page plan
for itself and nothing for the others.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType

from ..functions.columns import q
from ..operators.heavy import heavy_keys, sketch
from ..operators.nest import PAGE, cut_pages, nest, small_keys

# A lookup side (a dimension such as clients with their accounts) is broadcast
# only when its tables are measured under both budgets: rows per table, and
# bytes (twice their JSON text size). Beyond them the join shuffles and
# adaptive execution splits skewed keys.
LOOKUP_BROADCAST_ROWS = 1_000_000
LOOKUP_BROADCAST_BYTES = 256 * 1024 * 1024

# A lookup key with more rows than this is hot: its rows meet a sent copy of the
# looked-up row instead of all going to one task.
LOOKUP_HOT_ROWS = 1_000_000

# The list bound the shipped job uses: no list (and so no task building one)
# holds more than this many items; keys with more children get more pages.
DEFAULT_MAX_ITEMS = 1_000_000

# Where the bound of a page is lower, lists of up to this weight are gathered by one
# task and cut into pages in place; only heavier ones are sorted over several tasks.
GATHER_ITEMS = 50_000

_INT_RANK = {ByteType(): 1, ShortType(): 2, IntegerType(): 3, LongType(): 4}


@dataclass(frozen=True)
class Child:
    """Rows of ``spec`` folded into the list ``out`` of their parent.

    ``fk`` is the child column holding the parent's key. ``how="left"`` keeps a
    parent without children (its list is null); ``"inner"`` drops it.
    """

    spec: "DocSpec"
    fk: str
    out: str
    how: str = "left"


@dataclass(frozen=True)
class Lookup:
    """Columns of ``spec`` (one row per ``spec.key``) copied into each row.

    ``on`` is this table's column holding the looked-up key.
    """

    spec: "DocSpec"
    on: str
    how: str = "left"


@dataclass(frozen=True)
class DocSpec:
    table: str
    key: str | None = None
    children: tuple[Child, ...] = ()
    lookups: tuple[Lookup, ...] = ()
    drop: tuple[str, ...] = ()
    rename: tuple[tuple[str, str], ...] = ()
    order_by: tuple[str, ...] | None = None

    def with_children(self, *outs: str) -> "DocSpec":
        """The same spec keeping only the children whose list names are given."""
        return replace(self, children=tuple(c for c in self.children if c.out in outs))


@dataclass
class BuildOptions:
    """How a spec is built.

    sort: sort every list (results then repeat exactly run to run).
    max_items: bound on what a list weighs (1 for each item and 1 for each item
        of its own lists); heavier lists are paged (see nest).
    gather_items: what a list may weigh to be gathered whole by one task before
        it is cut into pages (where max_items is higher, that is the bound).
    lookup_broadcast_rows, lookup_broadcast_bytes: budgets under which a
        lookup side is broadcast (see lookup_fits).
    lookup_hot_rows: where a lookup side is over those budgets, keys with more
        rows than this are looked up by sending their side alone (None: all
        rows are shuffled, and no key is measured).
    persist: storage level for the built frames (off: nothing is read twice).
    checkpoint_lists: write every nested list side as a reliable checkpoint
        (to spark.checkpoint.dir) before it is joined. The joins then restart
        from those files if executors are lost, instead of redoing the nests.
        Cost: one more write of each list side, and one exchange of it, as a
        checkpointed frame does not carry its hash partitioning into the join.
    stable_inputs: the tables are file scans (or give the same partitions
        and row order on every read in some other way), with row-wise
        filters and projections at most. A list of such a table (a child
        without children or lookups of its own) is then paged without first
        checkpointing its rows: its three reads number the rows the same, so
        a heavy key in a large table costs no rewrite of that table. Rows
        built through joins are still checkpointed before paging.
    """

    sort: bool = True
    max_items: int | None = None
    gather_items: int = GATHER_ITEMS
    lookup_broadcast_rows: int = LOOKUP_BROADCAST_ROWS
    lookup_broadcast_bytes: int = LOOKUP_BROADCAST_BYTES
    lookup_hot_rows: int | None = LOOKUP_HOT_ROWS
    persist: StorageLevel | None = None
    checkpoint_lists: bool = False
    stable_inputs: bool = False


def _wider(a: DataType, b: DataType) -> DataType | None:
    if a == b:
        return None
    if a in _INT_RANK and b in _INT_RANK:
        return a if _INT_RANK[a] >= _INT_RANK[b] else b
    return None


def align_key_types(left: DataFrame, lkey: str, right: DataFrame, rkey: str) -> tuple[DataFrame, DataFrame]:
    """Cast the narrower of two integer keys up front, so the join compares
    equal types and the existing hash partitioning of both sides is reused."""
    lt, rt = left.schema[lkey].dataType, right.schema[rkey].dataType
    wide = _wider(lt, rt)
    if wide is None:
        return left, right
    if lt != wide:
        left = left.withColumn(lkey, q(lkey).cast(wide))
    if rt != wide:
        right = right.withColumn(rkey, q(rkey).cast(wide))
    return left, right


def row_counts(frames: list[DataFrame]) -> list[int]:
    """Rows of each frame, all in one job.

    Only the columns a frame's filters need are read (a bare Parquet scan is
    counted from its row groups), so this is cheap however wide the rows are.
    Every task reads its whole split: a limit under an aggregation would not
    stop the scan early, it only caps each task's rows.
    """
    if not frames:
        return []
    tagged = [f.select(F.lit(i).alias("_t")) for i, f in enumerate(frames)]
    counts = reduce(lambda a, b: a.unionByName(b), tagged).groupBy("_t").agg(F.count(F.lit(1)).alias("n"))
    found = {r["_t"]: r["n"] for r in counts.collect()}  # one row per frame
    return [found.get(i, 0) for i in range(len(frames))]


def json_bytes(frames: list[DataFrame]) -> int:
    """Bytes of the rows of all frames as JSON text (lists included), one job.
    Meant for frames already counted under a row budget."""
    if not frames:
        return 0
    sized = [f.select(F.octet_length(F.to_json(F.struct(*[q(c) for c in f.columns]))).alias("_b")) for f in frames]
    total = reduce(lambda a, b: a.unionByName(b), sized).agg(F.sum("_b").alias("b")).collect()[0]["b"]
    return int(total or 0)


def bounded_broadcast(
    df: DataFrame, max_rows: int, max_bytes: int = LOOKUP_BROADCAST_BYTES, base: DataFrame | None = None
) -> DataFrame:
    """Broadcast ``df`` only when measured under ``max_rows`` rows and
    ``max_bytes`` bytes; else return it as it is (the join then shuffles).

    ``base`` is a table with at least as many rows as ``df`` (its source
    table): its row count is the row check, so ``df`` itself is only computed
    once it is known to be small. The bytes are then measured on ``df`` as
    JSON text (lists included), counted twice for headroom over the
    in-memory size. A large side costs one count (pruned to the columns its
    filters need), never a read of its whole rows.
    """
    if max_rows <= 0 or max_bytes <= 0:
        return df
    if row_counts([df if base is None else base])[0] > max_rows:
        return df
    if 2 * json_bytes([df]) <= max_bytes:
        return F.broadcast(df)
    return df


def _subtree_specs(spec: DocSpec) -> list[DocSpec]:
    out = [spec]
    for lk in spec.lookups:
        out += _subtree_specs(lk.spec)
    for ch in spec.children:
        out += _subtree_specs(ch.spec)
    return out


def lookup_fits(
    spec: DocSpec, tables: Mapping[str, DataFrame], max_rows: int, max_bytes: int, counts: list[int] | None = None
) -> bool:
    """Whether the built ``spec`` is proven small enough to broadcast.

    Measures the base tables of the spec's whole tree instead of the built
    side (which would have to be computed for it): the side's rows are made
    of their rows, lists included, so their sizes bound it. First one job
    counts the rows of every table (reading only the columns their filters
    need); only when each is under max_rows does a second job measure their
    bytes, as JSON text counted twice for headroom over the in-memory size.
    A large table therefore costs a count, never a read of its whole rows.
    ``counts`` passes those row counts when already made (in the same order
    as the tables of the tree).
    """
    if max_rows <= 0 or max_bytes <= 0:
        return False
    frames = [_prepare(s, tables) for s in _subtree_specs(spec)]
    if any(n > max_rows for n in (row_counts(frames) if counts is None else counts)):
        return False
    return 2 * json_bytes(frames) <= max_bytes


def _prepare(spec: DocSpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    if spec.table not in tables:
        raise KeyError(f"no table {spec.table!r}; have {sorted(tables)}")
    df = tables[spec.table]
    if spec.rename:
        df = df.withColumnsRenamed(dict(spec.rename))
    if spec.drop:
        df = df.drop(*spec.drop)
    return df


Path = tuple[str, ...]


def _child_path(path: Path, ch: Child) -> Path:
    return (*path, ch.out)


def _lookup_path(path: Path, lk: Lookup) -> Path:
    return (*path, "@" + lk.on)


def _children(spec: DocSpec, path: Path = ()) -> Iterator[tuple[Path, Child]]:
    """Every Child of the spec tree (through lookups too) with its place in the tree, depth first."""
    for lk in spec.lookups:
        yield from _children(lk.spec, _lookup_path(path, lk))
    for ch in spec.children:
        yield _child_path(path, ch), ch
        yield from _children(ch.spec, _child_path(path, ch))


def _lookups(spec: DocSpec, path: Path = ()) -> Iterator[tuple[Path, Lookup]]:
    """Every Lookup of the spec tree with its place, depth first."""
    for lk in spec.lookups:
        yield _lookup_path(path, lk), lk
        yield from _lookups(lk.spec, _lookup_path(path, lk))
    for ch in spec.children:
        yield from _lookups(ch.spec, _child_path(path, ch))


def _keys_of(ch: Child, tables, nulls: bool) -> DataFrame:
    keys = _prepare(ch.spec, tables).select(q(ch.fk))
    return keys if nulls else keys.where(q(ch.fk).isNotNull())


def heavy_key_counts(
    spec: DocSpec, tables: Mapping[str, DataFrame], max_items: int, lookup_rows: dict | None = None, nulls: bool = True
) -> dict[int, int]:
    """For every Child of the tree, how many parent keys have more than
    ``max_items`` child rows (by ``id(child)``; a null key counts as a key).

    One job fills a sketch of each child's key column (see
    :mod:`nestdoc.operators.heavy`); only children with candidates are counted
    further, and of them only the candidates' rows.

    ``nulls=False`` leaves null keys out: rows that no parent takes need no pages.

    A dict as ``lookup_rows`` is filled with the rows of the tables of every
    Lookup's tree (the row check of its broadcast, see lookup_fits):
    ``id(lookup) -> [rows per table]``.
    """
    entries = [ch for _, ch in _children(spec)]
    frames = [(_keys_of(ch, tables, nulls), [ch.fk]) for ch in entries]
    found = {}
    for ch, (rows, keys), seen in zip(entries, frames, sketch(frames, max_items), strict=True):
        heavy = heavy_keys(rows, keys, max_items, sketched=seen)
        found[id(ch)] = 0 if heavy is None else heavy.count()
    if lookup_rows is not None:
        for (_, lk), rows in zip(_lookups(spec), _lookup_tables(spec, tables), strict=True):
            lookup_rows[id(lk)] = rows
    return found


def _lookup_tables(spec: DocSpec, tables) -> list[list[int]]:
    """Rows of each table of each lookup's tree, all in one job."""
    frames = [[_prepare(t, tables) for t in _subtree_specs(lk.spec)] for _, lk in _lookups(spec)]
    counts = iter(row_counts([f for group in frames for f in group]))
    return [[next(counts) for _ in group] for group in frames]


@dataclass
class Heavy:
    """What is measured before a bounded document is planned.

    keys: by place in the tree, the parent keys (and their weight, ``_n``) of
        which that list weighs more than the bound; only lists that have some.
    counts: how many they are. lookup_rows: see lookup_fits.
    short: lists that are known to be one page for every key.
    """

    keys: dict[Path, DataFrame] = field(default_factory=dict)
    counts: dict[Path, int] = field(default_factory=dict)
    lookup_rows: dict[Path, list[int]] = field(default_factory=dict)
    short: set[Path] = field(default_factory=set)

    def light(self) -> "Heavy":
        """The same where no list is heavy."""
        return Heavy(lookup_rows=self.lookup_rows, short=self.short)

    def of(self, spec: DocSpec, path: Path) -> DataFrame | None:
        """The keys of ``spec`` with a heavy list (one column ``_k``), marked to be sent if few."""
        parts = [(self.keys[p], ch.fk, self.counts[p]) for ch in spec.children if (p := _child_path(path, ch)) in self.keys]
        if not parts:
            return None
        keys = reduce(DataFrame.unionByName, [df.select(q(fk).alias("_k")) for df, fk, _ in parts])
        keys = keys.where(F.col("_k").isNotNull())
        return small_keys(keys.distinct() if len(parts) > 1 else keys, ["_k"], sum(n for _, _, n in parts))[0]


def _row_bound(spec: DocSpec, path: Path, most: dict[Path, int]) -> int:
    """Items that the lists of one row can hold at most, given the most rows of any key."""
    return sum(_list_bound(ch, _child_path(path, ch), most) for ch in spec.children) + sum(
        _row_bound(lk.spec, _lookup_path(path, lk), most) for lk in spec.lookups
    )


def _list_bound(ch: Child, path: Path, most: dict[Path, int]) -> int:
    return most[path] * (1 + _row_bound(ch.spec, path, most))


def _has_lists(spec: DocSpec) -> bool:
    return bool(spec.children) or any(_has_lists(lk.spec) for lk in spec.lookups)


def _row_weights(spec: DocSpec, tables, cols: list[str]) -> DataFrame:
    """``cols`` of each row and its weight ``_w``: 1 and the items of all lists below it.
    Only key columns are read."""
    needed = list(dict.fromkeys([*cols, *([spec.key] if spec.children else []), *[lk.on for lk in spec.lookups]]))
    df = _prepare(spec, tables).select(*[q(c) for c in needed], F.lit(1).cast("bigint").alias("_w"))
    sides = [(spec.key, _list_weights(ch, tables), ch.fk, F.col("_n")) for ch in spec.children]
    for lk in spec.lookups:
        if _has_lists(lk.spec):
            sides.append((lk.on, _row_weights(lk.spec, tables, [lk.spec.key]), lk.spec.key, F.col("_w") - 1))
    for on, side, key, weight in sides:
        side = side.select(q(key).alias("_side"), weight.alias("_more"))
        df, side = align_key_types(df, on, side, "_side")
        df = df.join(side, q(on) == F.col("_side"), "left").select(
            *[q(c) for c in needed], (F.col("_w") + F.coalesce("_more", F.lit(0))).alias("_w")
        )
    return df.select(*[q(c) for c in cols], "_w")


def _list_weights(ch: Child, tables, nulls: bool = False) -> DataFrame:
    """The weight (``_n``) of the list of each parent key."""
    rows = _row_weights(ch.spec, tables, [ch.fk])
    if not nulls:
        rows = rows.where(q(ch.fk).isNotNull())
    return rows.groupBy(q(ch.fk)).agg(F.sum("_w").alias("_n"))


def _measured(spec: DocSpec, tables: Mapping[str, DataFrame], opts: BuildOptions, nulls: Path | None = None) -> Heavy:
    """What is measured for the options; nothing where lists are unbounded."""
    if not opts.max_items:
        return Heavy()
    return measure(spec, tables, max(opts.max_items, opts.gather_items), nulls, page=opts.max_items)


def measure(
    spec: DocSpec, tables: Mapping[str, DataFrame], max_items: int, nulls: Path | None = None, page: int | None = None
) -> Heavy:
    """Which lists are over the bound, and for which keys; and which are within ``page`` for all.

    One job sketches the key columns of all children. The most rows of any
    key, multiplied down the tree, bound every list's weight; for most inputs
    that settles that nothing is heavy. Only lists that could be over the
    bound are weighed (leaves by their candidates' rows, lists of lists by
    joining key columns), and the few heavy keys are written as a reliable
    checkpoint. Null keys do not count but for the list at ``nulls``.
    """
    entries = list(_children(spec))
    frames = [(_keys_of(ch, tables, path == nulls), [ch.fk]) for path, ch in entries]
    sketches = sketch(frames, max_items)
    most = {path: s.most for (path, _), s in zip(entries, sketches, strict=True)}
    out = Heavy(lookup_rows={p: n for (p, _), n in zip(_lookups(spec), _lookup_tables(spec, tables), strict=True)})
    out.short = {path for path, ch in entries if _list_bound(ch, path, most) <= (max_items if page is None else page)}
    for (path, ch), (rows, keys), seen in zip(entries, frames, sketches, strict=True):
        if _list_bound(ch, path, most) <= max_items:
            continue
        if _has_lists(ch.spec):
            heavy = _list_weights(ch, tables, path == nulls).where(F.col("_n") > max_items)
        else:
            heavy = heavy_keys(rows, keys, max_items, sketched=seen)
        if heavy is None:
            continue
        heavy = heavy.checkpoint(eager=True)
        n = heavy.count()
        if n:
            out.keys[path], out.counts[path] = heavy, n
    return out


def _without(df: DataFrame, col: str, keys: DataFrame | None) -> DataFrame:
    """The rows whose key is not among ``keys`` (null ones stay)."""
    return df if keys is None else df.join(keys, q(col) == F.col("_k"), "left_anti")


def _light_side(spec: DocSpec, path: Path, tables, heavy: Heavy, out: dict, drop: tuple = ()) -> DocSpec:
    """The spec over the rows that belong to light keys at every level; its tables go to ``out``
    under names of their own."""
    frame = _prepare(spec, tables)
    for col, keys in drop:
        frame = _without(frame, col, keys)
    hot = heavy.of(spec, path)
    children = tuple(
        replace(ch, spec=_light_side(ch.spec, _child_path(path, ch), tables, heavy, out, ((ch.fk, hot),))) for ch in spec.children
    )
    lookups = tuple(replace(lk, spec=_light_side(lk.spec, _lookup_path(path, lk), tables, heavy, out)) for lk in spec.lookups)
    return _rebound(spec, frame, out, children=children, lookups=lookups)


def _heavy_side(spec: DocSpec, tables, out: dict, col: str, keys: DataFrame) -> DocSpec:
    """The spec over the rows of the given keys and of what hangs from them; lookups stay whole."""
    frame = _prepare(spec, tables).join(keys, q(col) == F.col("_k"), "left_semi")
    below = frame.select(q(spec.key).alias("_k")) if spec.children else None
    if col == spec.key:
        below = keys
    children = tuple(replace(ch, spec=_heavy_side(ch.spec, tables, out, ch.fk, below)) for ch in spec.children)
    return _rebound(spec, frame, out, children=children)


def _rebound(spec: DocSpec, frame: DataFrame, out: dict, **changes) -> DocSpec:
    name = f"{spec.table}#{len(out)}"
    out[name] = frame
    return replace(spec, table=name, drop=(), rename=(), **changes)


def split(spec: DocSpec, tables, heavy: Heavy, path: Path = ()) -> tuple[tuple[DocSpec, dict], tuple[DocSpec, dict]]:
    """The spec and tables of the light parents, and those of the heavy ones."""
    hot = heavy.of(spec, path)
    light, few = dict(tables), dict(tables)
    light_spec = _light_side(spec, path, tables, heavy, light, ((spec.key, hot),))
    return (light_spec, light), (_heavy_side(spec, tables, few, spec.key, hot), few)


def _apply_lookup(df: DataFrame, lk: Lookup, path: Path, tables, opts: BuildOptions, heavy: Heavy) -> DataFrame:
    if lk.spec.key is None:
        raise ValueError(f"lookup table {lk.spec.table!r} needs a key")

    def side_of(spec: DocSpec, source) -> DataFrame:
        built = _build(spec, path, source, opts, heavy)
        return built.withColumnRenamed(lk.spec.key, lk.on)

    side = side_of(lk.spec, tables)
    clash = sorted((set(df.columns) & set(side.columns)) - {lk.on})
    if clash:
        raise ValueError(f"lookup {lk.spec.table!r} would repeat columns {clash}; rename or drop them in the spec")
    counts = heavy.lookup_rows.get(path)

    def joined(rows: DataFrame, side: DataFrame, send: bool) -> DataFrame:
        rows, side = align_key_types(rows, lk.on, side, lk.on)
        cols = [q(c) for c in rows.columns] + [q(c) for c in side.columns if c != lk.on]
        return rows.join(F.broadcast(side) if send else side, lk.on, lk.how).select(*cols)

    if lookup_fits(lk.spec, tables, opts.lookup_broadcast_rows, opts.lookup_broadcast_bytes, counts):
        return joined(df, side, True)
    # The side is too large to send. Keys that hold a mass of rows (a client in half of all
    # policies) are looked up apart: their own few rows of the side are sent, and only the
    # others' rows are shuffled.
    hot = None
    if opts.lookup_hot_rows is not None:
        hot = heavy_keys(df.select(q(lk.on)), [lk.on], opts.lookup_hot_rows, nulls=False)
    if hot is None:
        return joined(df, side, False)
    hot = hot.select(q(lk.on).alias("_k")).checkpoint(eager=True)
    few: dict = dict(tables)
    few_spec = _heavy_side(lk.spec, tables, few, lk.spec.key, hot)
    sizes = row_counts([few[s.table] for s in _subtree_specs(few_spec) if s.table in few])
    hot = small_keys(hot, ["_k"])[0]
    send = lookup_fits(few_spec, few, LOOKUP_BROADCAST_ROWS, LOOKUP_BROADCAST_BYTES, sizes)
    if not send:
        return joined(df, side, False)
    rest = joined(_without(df, lk.on, hot), side, False)
    return rest.unionByName(joined(df.join(hot, q(lk.on) == F.col("_k"), "left_semi"), side_of(few_spec, few), True))


def _items(col: Column, spec: DocSpec) -> Column:
    """What a list of rows of ``spec`` weighs; 0 for a null list."""
    if not _has_lists(spec):
        return F.when(col.isNull(), 0).otherwise(F.size(col)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.aggregate(col, zero, lambda acc, x: acc + _weight(spec, lambda name: x[name])), zero)


def _weight(spec: DocSpec, get=q) -> Column:
    """What a built row of ``spec`` weighs: 1 and the weight of its lists."""
    total = F.lit(1).cast("bigint")
    for ch in spec.children:
        total = total + _items(get(ch.out), ch.spec)
    for lk in spec.lookups:
        if _has_lists(lk.spec):
            total = total + _weight(lk.spec, get) - 1
    return total


def _cut(df: DataFrame, lists: list[tuple[Child, Path]], opts: BuildOptions, heavy: Heavy) -> DataFrame:
    """Rows with whole lists, none of them heavy, cut into pages."""
    whole = opts.max_items >= opts.gather_items
    weights = {
        ch.out: (lambda x, spec=ch.spec: _weight(spec, lambda name: x[name])) if _has_lists(ch.spec) else None for ch, _ in lists
    }
    return cut_pages(df, weights, opts.max_items, short=[ch.out for ch, path in lists if whole or path in heavy.short])


def _nest_rows(rows: DataFrame, ch: Child, path: Path, opts: BuildOptions, heavy: Heavy) -> tuple[DataFrame, bool]:
    """Nest built child rows by their foreign key; True when paged."""
    if not heavy.counts.get(path):
        # no heavy key: the plain nest, joined like the unpaged document
        return nest(rows, ch.fk, ch.out, sort=opts.sort, order_by=ch.spec.order_by), False
    # rows read straight from a stable table need no checkpoint before paging
    leaf = not ch.spec.children and not ch.spec.lookups
    hot = heavy.keys[path]
    if hot.schema[ch.fk].dataType != rows.schema[ch.fk].dataType:
        hot = hot.withColumn(ch.fk, q(ch.fk).cast(rows.schema[ch.fk].dataType))
    lists = nest(
        rows, ch.fk, ch.out, sort=opts.sort, order_by=ch.spec.order_by, max_items=opts.max_items,
        hot_keys=hot, heavy_keys=heavy.counts[path], checkpoint=not (opts.stable_inputs and leaf),
        ordered_pages=opts.sort, weight=_weight(ch.spec) if _has_lists(ch.spec) else None,
        cut=lambda lists: _cut(lists, [(ch, path)], opts, heavy),
    )
    return lists, True


def nest_child(ch: Child, tables: Mapping[str, DataFrame], opts: BuildOptions | None = None) -> DataFrame:
    """The lists of one Child on their own: ``(fk, out)``, or ``(fk, page, out)``
    when ``opts.max_items`` is set (every key then has a page 0)."""
    opts = opts or BuildOptions()
    path = _child_path((), ch)
    heavy = _measured(DocSpec("", children=(ch,)), tables, opts, nulls=path)
    rows = _build(ch.spec, path, tables, opts, heavy)
    lists, paged = _nest_rows(rows, ch, path, opts, heavy)
    return _cut(lists, [(ch, path)], opts, heavy) if opts.max_items and not paged else lists


def _child_lists(df: DataFrame, spec: DocSpec, ch: Child, path: Path, tables, opts: BuildOptions, heavy: Heavy):
    rows = _build(ch.spec, path, tables, opts, heavy)
    if ch.fk not in rows.columns:
        raise ValueError(f"child {ch.spec.table!r} has no column {ch.fk!r}")
    # a child row without parent key can never be attached: leave it out
    # before the shuffle (so a mass of null keys is never one task's list)
    rows = rows.where(q(ch.fk).isNotNull())
    # cast before the nest, so the nest's exchange already uses the join type
    df, rows = align_key_types(df, spec.key, rows, ch.fk)
    lists, paged = _nest_rows(rows, ch, path, opts, heavy)
    if opts.checkpoint_lists:
        lists = lists.checkpoint(eager=True)
    return df, lists.withColumnRenamed(ch.fk, spec.key), paged


def build(spec: DocSpec, tables: Mapping[str, DataFrame], opts: BuildOptions | None = None) -> DataFrame:
    """One row per row of ``spec.table``, lookups copied in, children as lists.

    List columns come in the order of ``spec.children``; an unmatched left
    child gives a null list. With ``opts.max_items`` set, every row that has
    children carries a ``page`` column and no list of a row weighs more than
    max_items plus its last item (an item weighs 1 and what its own lists
    hold; those are bounded in turn, so a list holds less than two max_items
    of items of all levels): a key with more gets several pages, and page p of
    a key holds page p of each of its lists. One job first looks for heavy
    keys in the whole tree; light keys take the unpaged plan, and their lists
    are cut into pages in place.
    """
    opts = opts or BuildOptions()
    return _build(spec, (), tables, opts, _measured(spec, tables, opts))


def _mostly_heavy(spec: DocSpec, path: Path, tables, heavy: Heavy) -> bool:
    """Whether over half of the parents may be heavy: then one page plan is cheaper than two plans."""
    counts = [heavy.counts.get(_child_path(path, ch), 0) for ch in spec.children]
    return 2 * max(counts) > row_counts([_prepare(spec, tables)])[0]


def _build(spec: DocSpec, path: Path, tables, opts: BuildOptions, heavy: Heavy, may_split: bool = True) -> DataFrame:
    if spec.children and spec.key is None:
        raise ValueError(f"table {spec.table!r} has children but no key")
    for ch in spec.children:
        if ch.how not in ("left", "inner"):
            raise ValueError(f"child join must be left or inner, got {ch.how!r}")
    paged = any(heavy.counts.get(_child_path(path, ch)) for ch in spec.children)
    if paged and may_split and not _mostly_heavy(spec, path, tables, heavy):
        (light_spec, light), (few_spec, few) = split(spec, tables, heavy, path)
        plain = _build(light_spec, path, light, opts, heavy.light())
        return plain.unionByName(_build(few_spec, path, few, opts, heavy, may_split=False))

    df = _prepare(spec, tables)
    for lk in spec.lookups:
        df = _apply_lookup(df, lk, _lookup_path(path, lk), tables, opts, heavy)
    if not spec.children:
        return df.persist(opts.persist) if opts.persist else df
    if opts.max_items and PAGE in df.columns:
        # its rows repeat once per page of a looked-up list; attaching the
        # children to every copy would repeat their items (a table's own
        # column of that name would clash with the page number)
        raise ValueError(
            f"table {spec.table!r} has children and a lookup whose lists are paged; "
            "raise max_items or move the lookup's lists below a child"
        )

    lists = []
    for ch in spec.children:
        df, side, is_paged = _child_lists(df, spec, ch, _child_path(path, ch), tables, opts, heavy)
        lists.append((ch, side, is_paged))
    # a later child may have widened the parent key: widen earlier lists too
    lists = [(ch, align_key_types(df, spec.key, side, spec.key)[1], p) for ch, side, p in lists]
    base_cols = [q(c) for c in df.columns]

    if any(p for _, _, p in lists):
        lists = [
            (ch, side if p else _cut(side, [(ch, _child_path(path, ch))], opts, heavy)) for ch, side, p in lists
        ]
        out = _join_pages(df, spec.key, base_cols, lists)
    else:
        for ch, side, _ in lists:
            # A list side grows with its child table, so it is never broadcast:
            # it already comes hash-partitioned by the key out of its nest, and
            # a merge join then only shuffles the parent side.
            df = df.join(side.hint("merge"), spec.key, ch.how)
        out = df.select(*base_cols, *[q(ch.out) for ch, _, _ in lists])
        if opts.max_items:
            out = _cut(out, [(ch, _child_path(path, ch)) for ch in spec.children], opts, heavy)
    return out.persist(opts.persist) if opts.persist else out


def _join_pages(df: DataFrame, key: str, base_cols, lists) -> DataFrame:
    """Paged documents: page p of a key carries page p of every list.

    The pages of all lists meet on (key, page), so a heavy key's pages spread
    over tasks. Parent columns then reach every page through an inner join
    (adaptive execution may split a skewed partition of either side of an
    inner join); parents without any page come from an anti join on the
    page-0 keys (one row per key), with page 0 and null lists.
    """
    sides = []
    for ch, side in lists:
        if ch.how == "inner":
            # every key with children has a page 0
            df = df.join(side.where(F.col(PAGE) == 0).select(key).hint("merge"), key, "left_semi")
        sides.append(side)
    pages = reduce(lambda a, b: a.join(b, [key, PAGE], "full_outer"), sides)
    outs = [q(ch.out) for ch, _ in lists]
    with_pages = pages.join(df, key, "inner").select(*base_cols, q(PAGE), *outs)
    first_pages = pages.where(F.col(PAGE) == 0).select(key)
    without = df.join(first_pages, key, "left_anti").select(
        *base_cols, F.lit(0).cast("bigint").alias(PAGE), *[F.lit(None).cast(pages.schema[ch.out].dataType).alias(ch.out) for ch, _ in lists]
    )
    return with_pages.unionByName(without)
