"""What became of every input row of a document (K5, C8), counted in the write's own pass.

Each input is observed where it is scanned (its rows, and those without a parent
key) and the document where it is written (its rows, and the items of every list).
Nothing is read or computed a second time: the numbers come back with the write.

For a child table ``rows = in_document + no_key + left_out``: left out are rows
whose parent is not in its table or not in the document. For the root table left
out are rows that an inner list drops. Tables below a lookup are copied into every
row that looks them up, so for them ``in_document`` counts copies and nothing is
left out or added up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import q
from .spec import BuildOptions, Child, DocSpec, Heavy, _build, _prepare


@dataclass(frozen=True)
class Account:
    """Rows of one input (``name``: its place in the document)."""

    name: str
    table: str
    rows: int
    in_document: int
    no_key: int = 0
    left_out: int = 0
    copied: bool = False


def _items_of(col: Column, path: list[str]) -> Column:
    """Items of the list at the end of ``path`` of list columns, over all items of the lists before."""
    if not path:
        return F.when(col.isNull(), 0).otherwise(F.size(col)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.aggregate(col, zero, lambda acc, x: acc + _items_of(x[path[0]], path[1:])), zero)


def _lists(spec: DocSpec, lists: tuple[str, ...] = (), copied: bool = False) -> Iterator[tuple[tuple[str, ...], Child, bool]]:
    for lk in spec.lookups:
        yield from _lists(lk.spec, lists, True)
    for ch in spec.children:
        yield (*lists, ch.out), ch, copied
        yield from _lists(ch.spec, (*lists, ch.out), copied)


def accounted(
    spec: DocSpec, tables: Mapping[str, DataFrame], opts: BuildOptions | None = None
) -> tuple[DataFrame, Callable[[], tuple[Account, ...]]]:
    """The document of ``spec`` (whole lists, see :func:`.spec.build`) and a function that returns
    the accounts once the document has been written, or otherwise run, exactly once."""
    opts = opts or BuildOptions()
    if opts.max_items:
        raise ValueError("accounts are of documents with whole lists: pages read an input more than once")
    seen: dict[tuple[str, ...], tuple[Observation, str, bool]] = {}
    out_tables: dict[str, DataFrame] = {}

    def watch(s: DocSpec, at: tuple[str, ...], fk: str | None, copied: bool) -> DocSpec:
        obs = Observation("rows of " + ("/".join(at) or s.table))
        frame = _prepare(s, tables)
        lost = F.count_if(q(fk).isNull() if fk else F.lit(False))
        name = f"{s.table}#{len(out_tables)}"
        out_tables[name] = frame.observe(obs, F.count(F.lit(1)).alias("rows"), lost.alias("no_key"))
        seen[at] = (obs, s.table, copied)
        children = tuple(replace(ch, spec=watch(ch.spec, (*at, ch.out), ch.fk, copied)) for ch in s.children)
        lookups = tuple(replace(lk, spec=watch(lk.spec, (*at, "@" + lk.on), None, True)) for lk in s.lookups)
        return replace(s, table=name, drop=(), rename=(), children=children, lookups=lookups)

    watched = watch(spec, (), None, False)
    # The lookup joins shuffle: measuring their sides would run the watched tables once more.
    doc = _build(watched, (), out_tables, replace(opts, lookup_broadcast_rows=0, lookup_hot_rows=None), Heavy())
    lists = list(_lists(spec))
    out = Observation("document")
    sums = [F.sum(_items_of(q(p[0]), list(p[1:]))).alias(f"n{k}") for k, (p, _, _) in enumerate(lists)]
    doc = doc.observe(out, F.count(F.lit(1)).alias("rows"), *sums)

    def finish() -> tuple[Account, ...]:
        got = out.get
        in_doc = {p: int(got[f"n{k}"] or 0) for k, (p, _, _) in enumerate(lists)}
        accounts = []
        for at, (obs, table, copied) in seen.items():
            rows, no_key = int(obs.get["rows"]), int(obs.get["no_key"] or 0)
            plain = tuple(x for x in at if not x.startswith("@"))
            if at and at[-1].startswith("@"):  # a looked-up row itself is no item
                accounts.append(Account("/".join(at), table, rows, 0, copied=True))
                continue
            kept = in_doc[plain] if at else int(got["rows"])
            left = 0 if copied else rows - kept - no_key
            accounts.append(Account("/".join(at) or table, table, rows, kept, no_key, left, copied))
        return tuple(accounts)

    return doc, finish
