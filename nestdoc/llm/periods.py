"""Periodic runs of words by multi-scale minimisers.

A run is a stretch of words with smallest period q (words q apart are identical) that is at
least `least` words and two periods long and cannot grow by a word. They are found in each
chunk of documents without comparing all pairs of places:

* Periods below `SHORT` words: a direct scan of each lag.
* At scale w = SHORT, 2 SHORT, ... the periods from w to 2w - 1: a window of w / 2 grams of
  g = w / 2 words spans less than a period, so a window inside a run has a twin one period on,
  and the two have their leftmost minimum at the same place. Places with equal minimisers at a
  lag of the scale are seeds; each is extended left and right to the run it lies in.

Grams that lie in a run of a short period (half a gram at most) repeat at every period, so
their places fold into one chain: pairs within a chain only restate that run, and between two
chains a pair of each lag does. Without chains equal grams are over half a gram apart, so a
place meets at most eight others of its scale. Work thus stays near the number of words times
its logarithm, whatever repeats. Extension compares hashes modulo the prime 2^61 - 1.

Defined results: null, empty and blank texts have no words and no runs; repeated rows and null
ids are each reported; an empty table gives an empty result. All columns of `docs` are kept,
whatever they are called; a new column whose name is taken gets underscores in front. Texts of
any length are whole: a task holds `CHUNK_BYTES` of text at a time, or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestdoc.llm._frames import WORD, quoted, table, widened
from nestdoc.llm._words import NON_SPACE, chunks, mix, spans_of, spread, utf8, words

U64 = np.uint64
#: Periods below are scanned lag by lag; a power of two.
SHORT = 16
#: Words of a reported run, besides two periods.
LEAST = 12
CHUNK_BYTES = 2 << 20

RUNS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "runs",
            T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])),
        ),
        T.StructField("collapsed", T.StringType()),
    ]
)

_PRIME = (1 << 61) - 1
_BASE = 0x1A2B3C4D5E6F789
_POWERS = np.ones(1, U64)


def _mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2^61 - 1 of numbers below it."""
    low31, low30 = U64((1 << 31) - 1), U64((1 << 30) - 1)
    a1, a0, b1, b0 = a >> U64(31), a & low31, b >> U64(31), b & low31
    mid = a1 * b0 + a0 * b1
    return _fold(((a1 * b1) << U64(1)) + (mid >> U64(30)) + ((mid & low30) << U64(31)) + a0 * b0)


def _fold(x: np.ndarray) -> np.ndarray:
    x = (x & U64(_PRIME)) + (x >> U64(61))
    return np.where(x >= U64(_PRIME), x - U64(_PRIME), x)


def _powers(n: int) -> np.ndarray:
    """Powers 0 to n - 1 of the base, kept for later chunks."""
    global _POWERS
    while len(_POWERS) < n:
        step = np.full(len(_POWERS), pow(_BASE, len(_POWERS), _PRIME), U64)
        _POWERS = np.concatenate((_POWERS, _mulmod(_POWERS, step)))
    return _POWERS


class Prefixes:
    """Equality of any two stretches of a sequence by prefix hashes."""

    def __init__(self, codes: np.ndarray):
        self.power = _powers(len(codes) + 1)
        terms = _mulmod(_fold(codes), self.power[: len(codes)])
        low = np.cumsum(terms & U64(0xFFFFFFFF), dtype=U64)
        high = np.cumsum(terms >> U64(32), dtype=U64)
        total = _fold(_mulmod(_fold(high), np.full(len(codes), 1 << 32, U64)) + _fold(low))
        self.sums = np.concatenate((np.zeros(1, U64), total))

    def equal(self, at: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether `size` words from `at` on equal those `lag` words later."""

        def stretch(p: np.ndarray) -> np.ndarray:
            return _fold(self.sums[p + size] + U64(_PRIME) - self.sums[p])

        return _mulmod(stretch(at), self.power[lag]) == stretch(at + lag)

    def reach(self, at: np.ndarray, lag: np.ndarray, most: np.ndarray, left: bool) -> np.ndarray:
        """How many words before (left) or from `at` on equal those `lag` later, up to `most`."""
        low, high = np.zeros(len(at), np.int64), most.copy()
        while (open_ := low < high).any():
            mid = (low + high + 1) >> 1
            same = self.equal(at - mid if left else at, lag, mid)
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)
        return low


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of runs (start, length, period) over the same words, the one with the smallest period."""
    runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
    new = np.ones(runs.shape[1], bool)
    new[1:] = (runs[0, 1:] != runs[0, :-1]) | (runs[1, 1:] != runs[1, :-1])
    return runs[:, new]


def _short_runs(codes: np.ndarray, short: int) -> np.ndarray:
    found = []
    for p in range(1, min(short, len(codes))):
        starts, ends = spans_of(codes[:-p] == codes[p:])
        use = ends - starts >= p
        starts, ends = starts[use], ends[use]
        found.append(np.stack((starts, ends - starts + p, np.full(len(starts), p))))
    return _smallest(np.concatenate(found, axis=1)) if found else np.zeros((3, 0), np.int64)


def _chains(at: np.ndarray, g: int, runs: np.ndarray) -> np.ndarray:
    """For each gram place the run of a short period that holds the whole gram, or -1. At most
    one does: two would share a gram, and so a period."""
    hold = np.flatnonzero((runs[2] <= g // 2) & (runs[1] >= g))
    out = np.full(len(at), -1, np.int64)
    if len(hold):
        k = np.maximum(np.searchsorted(runs[0, hold], at, "right") - 1, 0)
        inside = (runs[0, hold[k]] <= at) & (at + g <= runs[0, hold[k]] + runs[1, hold[k]])
        out[inside] = hold[k[inside]]
    return out


def _seeds(at: np.ndarray, name: np.ndarray, row: np.ndarray, w: int, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of equal minimisers at lags from w to 2w - 1, one of each lag for chains."""
    order = np.argsort(name, kind="stable")
    at, name, row = at[order], name[order], row[order]
    same = np.zeros(len(at) + 1, bool)
    same[1:-1] = (name[1:] == name[:-1]) & (row[1:] == row[:-1])
    use = same[1:] | same[:-1]
    at, same = at[use], same[:-1][use]
    if not len(at):
        return at, at
    chain = _chains(at, w // 2, runs)
    group = np.cumsum(~same)
    new = ~same
    new[1:] |= (chain[1:] < 0) | (chain[1:] != chain[:-1])
    block = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    wide = np.int64(at.max() + 2 * w + 1)
    key = block * wide + at
    places, lags = [], []
    d = 1
    a = np.arange(len(first) - 1)
    while True:
        a = a[a + d < len(first)]
        near = (group[first[a]] == group[first[a + d]]) & (at[first[a + d]] - at[last[a]] < 2 * w)
        a = a[near]
        if not len(a):
            break
        b = a + d
        head = at[first[b]]  # every member of a with the first of b
        lo = np.maximum(np.searchsorted(key, a * wide + np.maximum(head - 2 * w + 1, 0)), first[a])
        hi = np.minimum(np.searchsorted(key, a * wide + np.maximum(head - w, -1), "right"), last[a] + 1)
        members, of = spread(lo, np.maximum(lo, hi))
        places.append(at[members])
        lags.append(head[of] - at[members])
        tail = at[last[a]]  # the last of a with every other member of b
        lo = np.maximum(np.searchsorted(key, b * wide + tail + w), first[b] + 1)
        hi = np.minimum(np.searchsorted(key, b * wide + tail + 2 * w), last[b] + 1)
        members, of = spread(lo, np.maximum(lo, hi))
        places.append(tail[of])
        lags.append(at[members] - tail[of])
        d += 1
    if not places:
        return at[:0], at[:0]
    return np.concatenate(places), np.concatenate(lags)


def runs_of(hashes: np.ndarray, first: np.ndarray, short: int = SHORT) -> np.ndarray:
    """All runs of two periods or more of the rows whose words are hashes[first[r]:first[r+1]]:
    columns (row, start, length, period), by row, start and period."""
    counts = np.diff(first)
    rows = np.repeat(np.arange(len(counts)), counts)
    # A stop of its own after every row: no stretch passes it.
    begin = first[:-1] + np.arange(len(counts))
    codes = np.empty(len(hashes) + len(counts), U64)
    codes[np.arange(len(hashes)) + rows] = hashes
    codes[begin + counts] = mix(np.arange(len(counts), dtype=U64) + U64(0xD1B54A32D192ED03))
    runs = _short_runs(codes, short)
    prefixes = None
    name, at = codes, np.arange(len(codes))
    row = np.repeat(np.arange(len(counts)), counts + 1)
    g, w = 1, short
    while len(at):
        live = counts[row] >= 2 * w
        name, at, row = name[live], at[live], row[live]
        if not len(at):
            break
        left = (begin + counts)[row] - at  # words from here to the row's end
        while g < w // 2:
            name = mix(name + mix(np.append(name[g:], np.zeros(g, U64)) ^ U64(0x9E3779B97F4A7C15)))
            g *= 2
        low = np.arange(len(at))
        s = 1
        while s < g:
            other = np.append(low[s:], np.full(s, len(at) - 1))
            low = np.where(name[low] <= name[other], low, other)
            s *= 2
        low = low[left >= 2 * g - 1]
        low = low[np.append(True, low[1:] != low[:-1])]
        x, lag = _seeds(at[low], name[low], row[low], w, runs)
        if len(x):
            prefixes = prefixes or Prefixes(codes)
            r = np.searchsorted(begin, x, "right") - 1
            ahead = prefixes.reach(x, lag, (begin + counts)[r] - x - lag, left=False)
            back = prefixes.reach(x, lag, x - begin[r], left=True)
            use = ahead + back >= lag
            new = np.stack((x - back, ahead + back + lag, lag))[:, use]
            runs = _smallest(np.concatenate((runs, new), axis=1))
        w *= 2
    r = np.searchsorted(begin, runs[0], "right") - 1
    out = np.stack((r, runs[0] - begin[r], runs[1], runs[2])) if len(begin) else np.zeros((4, 0), np.int64)
    return out[:, np.lexsort((out[3], out[1], out[0]))]


def _collapsed(data: np.ndarray, w, runs: np.ndarray) -> pa.Array:
    """Texts of the words that no run holds after its first period, joined by one blank."""
    edge = np.zeros(len(w.hashes) + 1, np.int64)
    np.add.at(edge, w.first[runs[0]] + runs[1] + runs[3], 1)
    np.add.at(edge, w.first[runs[0]] + runs[1] + runs[2], -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    row = w.row[kept]
    n = len(w.first) - 1
    sizes = w.ends[kept] - w.starts[kept] + 1
    source, _ = spread(w.starts[kept], w.ends[kept] + 1)
    text = np.append(data, np.uint8(0x20))[source]
    stops = np.cumsum(sizes)
    text[stops - 1] = 0x20
    final = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    text = np.delete(text, stops[final] - 1)
    lengths = np.bincount(row, weights=sizes, minlength=n).astype(np.int64)
    lengths -= np.bincount(row, minlength=n) > 0
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(text)).cast(pa.string())


def _describe(column: pa.Array, least: int) -> pa.StructArray:
    data, offsets = utf8(column)
    w = words(data, offsets, NON_SPACE, lower=False)
    runs = runs_of(w.hashes, w.first)
    runs = runs[:, runs[2] >= np.maximum(least, 2 * runs[3])]
    borders = np.searchsorted(runs[0], np.arange(len(offsets))).astype(np.int32)
    items = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in runs[1:]], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(borders), items)
    return pa.StructArray.from_arrays(
        [pa.array(w.counts, pa.int64()), lists, _collapsed(data, w, runs)], ["n_words", "runs", "collapsed"]
    )


def find_runs(docs: DataFrame, text: str = "text", out: str = "periodic", least: int = LEAST, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """`docs` plus a struct column `out`: n_words, the runs (start, length, period) of the text by
    start and period, and the text with every run cut to its first period."""

    def read(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for part in chunks(batches, f"c{at}", chunk_bytes):
            yield part, [_describe(part.column(at), least)]

    return widened(docs, text, [(out, RUNS)], read)


def repeat_tails(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` in which the texts of a tenth of the ids, by their crc32, end in repetition: each
    word i >= a becomes the word a + (i - a) % p of the text, with a and p drawn by the hash."""
    h = F.crc32(quoted(doc_id).cast("string"))
    g = F.floor(h / 10)

    def tail(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        moved = F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1),
            lambda i: F.element_at(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int") + 1),
        )
        return F.when(n > 0, F.array_join(moved, " ")).otherwise("")

    # One-element lists bind the words once for all of their uses.
    bound = F.transform(F.array(F.regexp_extract_all(quoted(text), F.lit(WORD), F.lit(0))), tail)[0]
    return docs.withColumn(text, F.when((h % 10 == 0) & quoted(text).isNotNull(), bound).otherwise(quoted(text)))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document (a tenth of them made to end in repetition), the longest
    one, and digests of all runs and of the text without repetition."""
    docs = repeat_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = find_runs(docs)
    runs = F.col("periodic")["runs"]
    # the greatest length, then the smallest start and period
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    top = F.array_min(ranked)
    lines = F.transform(runs, lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        top["s"].alias("start"),
        (-top["l"]).alias("length"),
        top["p"].alias("period"),
        F.floor((-1000 * top["l"]) / top["p"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("periodic")["collapsed"], 256).alias("collapsed_sha256"),
    )
