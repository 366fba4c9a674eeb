"""Benchmark decontamination by suffix arrays of the training text.

Each task cuts its documents into shards of bounded size, sorts the suffixes of a shard's word
sequence (a suffix array) and binary-searches every benchmark suffix in it, word by word. That
gives the longest verbatim match of the suffix and all its locations. Suffixes that meet a word
which no benchmark item has before they can hold a whole window are left out of the array: no
benchmark suffix can match them that far. The documents are never shuffled; the benchmark goes
to the tasks in blocks of bounded size, one pass for each block.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lowered. A window is
`window` consecutive words of an item; an item of fewer words, but not none, is one window.

Defined results: a null or empty text has no words and no hits; a null item text is no item; a
null item id is the empty string, items that share an id are one item; repeated rows are each
reported; an empty benchmark hits nothing; an empty table gives an empty result. Extra columns
of `docs` are kept as they are whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestdoc.llm._frames import free_name, quoted, table
from nestdoc.llm._words import ALNUM, chunks, spans_of, utf8, words

WINDOW = 10
#: Bytes of text in one suffix array: the least, and the most where the benchmark is as large,
#: for each array is searched for the whole benchmark. A task holds about 17 bytes for each.
SHARD_BYTES = 2 << 20
MOST_SHARD_BYTES = 8 << 20
#: Bytes of benchmark text that a task searches for in one pass; its words fit 21-bit codes.
BLOCK_BYTES = 8 << 20

MATCHES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("longest", T.LongType()),
    ]
)


@dataclass
class Needles:
    """The suffixes of one block of benchmark items that are searched for."""

    vocabulary: np.ndarray  # sorted word hashes; a word's code is its place here plus 1
    codes: np.ndarray  # all items' words, each item followed by a 0
    at: np.ndarray  # where each searched suffix begins in codes
    left: np.ndarray  # its words to the end of its item
    need: np.ndarray  # words of its window
    item: np.ndarray  # its item
    names: list[str]


def needles(rows: list[tuple[str, str]], window: int) -> Needles:
    """Index of (item id, text) rows."""
    names = sorted({name for name, _ in rows})
    number = {name: k for k, name in enumerate(names)}
    w = words(*utf8(pa.array([text for _, text in rows], pa.large_string())), ALNUM)
    vocabulary = np.unique(w.hashes)
    row = w.row
    codes = np.zeros(len(w.hashes) + len(rows) + 1, np.int64)
    codes[np.arange(len(row)) + row] = np.searchsorted(vocabulary, w.hashes) + 1
    counts = w.counts
    left = w.first[row + 1] - np.arange(len(row))
    need = np.minimum(counts[row], window)
    use = left >= need
    item = np.array([number[name] for name, _ in rows], np.int64)[row] if rows else np.zeros(0, np.int64)
    return Needles(vocabulary, codes, (np.arange(len(row)) + row)[use], left[use], need[use], item[use], names)


def suffix_array(codes: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The positions `at` sorted by the words that follow them, up to `depth` words or a 0."""

    def key(p: np.ndarray, d: int) -> np.ndarray:
        return (codes[p + d] << 42) | (codes[p + d + 1] << 21) | codes[p + d + 2]

    order = at[np.argsort(first := key(at, 0), kind="stable")]
    keys = np.sort(first)
    group = np.cumsum(np.concatenate(([0], keys[1:] != keys[:-1]))) if len(at) else at
    d = 3
    while d < depth and len(order):
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = group[1:] == group[:-1]
        tied = np.flatnonzero((same[1:] | same[:-1]) & (codes[order + d - 1] != 0))
        if not len(tied):
            break
        keys = key(order[tied], d)
        by = np.lexsort((keys, group[tied]))
        order[tied] = order[tied][by]
        keys, part = keys[by], group[tied]
        step = np.zeros(len(order), np.int64)
        step[tied[1:]] = (keys[1:] != keys[:-1]) & (part[1:] == part[:-1])
        group = group + np.cumsum(step)
        d += 3
    return order


def search(codes: np.ndarray, order: np.ndarray, q: Needles) -> tuple[np.ndarray, ...]:
    """For each searched suffix: the range of `order` that shares its window, and the range and
    length of its longest match."""
    n = len(q.at)
    low, high = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    window = np.zeros((2, n), np.int64)
    best = np.zeros((3, n), np.int64)
    active = np.arange(n)

    def bound(which: np.ndarray, target: np.ndarray, d: int, above: bool) -> np.ndarray:
        a, b = low[which].copy(), high[which].copy()
        while (open_ := a < b).any():
            mid = (a + b) >> 1
            word = codes[order[np.minimum(mid, len(order) - 1)] + d]
            right = open_ & ((word <= target) if above else (word < target))
            a = np.where(right, mid + 1, a)
            b = np.where(open_ & ~right, mid, b)
        return a

    d = 0
    while len(active) and len(order):
        target = q.codes[q.at[active] + d]
        a, b = bound(active, target, d, False), bound(active, target, d, True)
        found = a < b
        active = active[found]
        low[active], high[active] = a[found], b[found]
        d += 1
        best[0, active], best[1, active], best[2, active] = low[active], high[active], d
        whole = active[q.need[active] == d]
        window[0, whole], window[1, whole] = low[whole], high[whole]
        active = active[q.left[active] > d]
    return window[0], window[1], best


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members of the ranges, and the range that each is of."""
    size = high - low
    of = np.repeat(np.arange(len(low)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[of], of


def match(column: pa.Array, q: Needles) -> list[dict]:
    """Matches of the needles in each text of one shard."""
    w = words(*utf8(column), ALNUM)
    counts, total = w.counts, len(w.hashes)
    out = [{"n_words": int(c), "starts": [], "ends": [], "items": [], "longest": 0} for c in counts]
    if not len(q.at) or not total:
        return out
    depth = int(q.left.max())
    place = np.searchsorted(q.vocabulary, w.hashes)
    known = q.vocabulary[np.minimum(place, len(q.vocabulary) - 1)] == w.hashes
    row = w.row
    spot = np.arange(total) + row  # a 0 stands between rows
    codes = np.zeros(total + len(counts) + depth + 4, np.int64)
    codes[spot] = np.where(known, place + 1, 0)
    zeros = np.flatnonzero(codes == 0)
    at = np.flatnonzero(codes)
    at = at[zeros[np.searchsorted(zeros, at)] - at >= q.need.min()]
    order = suffix_array(codes, at, depth)
    low, high, (best_low, best_high, best) = search(codes, order, q)

    hit = np.flatnonzero(low < high)
    if not len(hit):
        return out
    row_at = np.zeros(len(codes), np.int64)
    row_at[spot] = row
    ranges, which = np.unique(np.stack((low[hit], high[hit], q.need[hit])), axis=1, return_inverse=True)
    which = which.reshape(-1)
    members, of = _spread(ranges[0], ranges[1])
    p = order[members]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, p, 1)
    np.add.at(edge, p + ranges[2][of], -1)
    starts, ends = spans_of(np.cumsum(edge[:-1]) > 0)
    first = w.first[:-1] + np.arange(len(counts))  # where each row begins in codes
    for r, s, e in zip(row_at[starts].tolist(), starts.tolist(), ends.tolist(), strict=True):
        out[r]["starts"].append(int(s - first[r]))
        out[r]["ends"].append(int(e - first[r]))
    # Documents of each range, once; then the items that hold its window.
    pairs = np.unique(np.stack((of, row_at[p])), axis=1)
    by_range = np.unique(np.stack((which, q.item[hit])), axis=1)
    lo = np.searchsorted(by_range[0], pairs[0], "left")
    hi = np.searchsorted(by_range[0], pairs[0], "right")
    items, pair = _spread(lo, hi)
    found = np.unique(np.stack((pairs[1][pair], by_range[1][items])), axis=1)
    for r, k in found.T.tolist():
        out[r]["items"].append(q.names[k])
    deep = np.flatnonzero(best >= q.need)
    longest = np.unique(np.stack((best_low[deep], best_high[deep], best[deep])), axis=1)
    members, of = _spread(longest[0], longest[1])
    most = np.zeros(len(counts), np.int64)
    np.maximum.at(most, row_at[order[members]], longest[2][of])
    for r in np.flatnonzero(most).tolist():
        out[r]["longest"] = int(most[r])
    return out


def _join(old: dict | None, new: dict) -> dict:
    """Matches of two blocks of items in one document."""
    if not old or not old["starts"]:
        return new
    spans: list[list[int]] = []
    for s, e in sorted([*zip(old["starts"], old["ends"], strict=True), *zip(new["starts"], new["ends"], strict=True)]):
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(e, spans[-1][1])
        else:
            spans.append([s, e])
    return {
        "n_words": new["n_words"],
        "starts": [s for s, _ in spans],
        "ends": [e for _, e in spans],
        "items": sorted({*old["items"], *new["items"]}),
        "longest": max(old["longest"], new["longest"]),
    }


def shard_size(benchmark_bytes: int) -> int:
    """Bytes of text in one suffix array that is searched for so large a benchmark."""
    return min(max(SHARD_BYTES, benchmark_bytes), MOST_SHARD_BYTES)


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    out: str = "matches",
    window: int = WINDOW,
    shard_bytes: int | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """`docs` plus a struct column `out`: n_words, starts and ends of the hit word spans, the ids
    of the items found (as strings, sorted) and the words of the longest verbatim match.
    A shard is `shard_bytes` of text; unless given, it follows the size of the benchmark."""
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(quoted(item_id).cast("string"), F.lit("")).alias("id"), quoted(item_text).alias("text")
    ).where(F.col("text").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // block_bytes))
    if shard_bytes is None:
        shard_bytes = shard_size(size)
    fields = docs.schema.fields
    schema = T.StructType([*fields, T.StructField(out, MATCHES)])
    kind = pa.struct(
        [("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("longest", pa.int64())]
    )

    def searcher(shared, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = shared.value
            for shard in chunks(batches, text, shard_bytes):
                found = match(shard.column(shard.schema.get_field_index(text)), q)
                columns = list(shard.columns)
                if not first:
                    found = [_join(o, f) for o, f in zip(columns.pop().to_pylist(), found, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], names=[*(f.name for f in fields), out])

        return run

    df = docs
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.expr(f"pmod(xxhash64(id, text), {blocks})") == b)
        block = needles([(r["id"], r["text"]) for r in part.collect()], window)  # bounded by block_bytes
        df = df.mapInArrow(searcher(spark.sparkContext.broadcast(block), b == 0), schema)
    return df


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that share no window with any benchmark item, with their own columns."""
    out = free_name(docs, "matches")
    found = find_matches(docs, benchmark, text=text, out=out, **options)
    return found.where(F.size(quoted(out)["starts"]) == 0).select(*[quoted(c) for c in docs.columns])


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of benchmark windows in every document, and the items they come from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = F.col("matches")
    hit = F.aggregate(F.zip_with(m["starts"], m["ends"], lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return find_matches(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        m["n_words"].alias("n_words"),
        hit.alias("n_hit"),
        F.size(m["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(m["items"]), ","), 256).alias("items_sha256"),
        (F.size(m["starts"]) > 0).alias("contaminated"),
    )


_WORDS = r"""regexp_extract_all(translate(coalesce({0}, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
    array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
hits AS (
  SELECT doc_id, i, x.n, item_id
  FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)) x
  JOIN item_windows v ON v.n = x.n AND v.win = x.win),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
