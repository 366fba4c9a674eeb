"""Words of Arrow text columns as numpy arrays, without a Python loop per word.

Word classes are classes of bytes: in UTF-8 every byte of a non-ASCII character is 0x80 or
more, so "any character but ..." over ASCII exceptions is the same class of bytes. A word is
named by a 64-bit hash of its bytes; two different words share one with odds of 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: Bytes that are hashed in one go: its few arrays of 8 bytes for each fit a core's cache.
_BLOCK = 1 << 18

#: `[^\x20\x09-\x0D]+`
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of text with A-Z lowered
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z to a-z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a uint64 over all bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(max(n, _BLOCK), base, U64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=U64)
    return _POWERS["up"], _POWERS["down"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the rows' offsets in them; a null row is empty."""
    if column.null_count:
        column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(
    batches: Iterator[pa.RecordBatch], text: str, most_bytes: int, most_rows: int = 1 << 14
) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows to about `most_bytes` of text each; one row is never cut."""
    for batch in batches:
        _, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1
            to = min(max(to, at + 1), at + most_rows, batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


@dataclass
class Words:
    """Words of some rows: byte starts and ends, hashes, and for each row its first word."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # one more than rows: words of row r are first[r]:first[r + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray, lower: bool = True) -> Words:
    """Words of every row, whole texts; `word_byte` says which bytes belong to a word."""
    if lower:
        data = LOWER[data]
    inside = word_byte[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False  # a row's first byte has no byte before it
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(starts, ends, hash_spans(data, starts, ends), np.searchsorted(starts, offsets))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches of bytes starts:ends, in order and without overlap."""
    hashes = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(ends, starts[at] + _BLOCK, "right")), at + 1)
        low, high = starts[at], ends[to - 1]
        up, down = _powers(int(high - low) + 1)
        sums = np.zeros(high - low + 1, U64)
        np.cumsum(_BYTE[data[low:high]] * up[: high - low], out=sums[1:])
        s = starts[at:to] - low
        hashes[at:to] = mix((sums[ends[at:to] - low] - sums[s]) * down[s])
        at = to
    return hashes


_PLACES = mix(np.arange(1000, 1064, dtype=U64)) | U64(1)


def ngrams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within a row, and the index of each run's first word."""
    total = len(w.hashes)
    left = np.repeat(w.first[1:], w.counts) - np.arange(total)
    at = np.flatnonzero(left >= n)
    out = np.zeros(len(at), U64)
    for k in range(n):
        out += w.hashes[at + k] * _PLACES[k]
    return mix(out), at


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members of the ranges low:high, and the range that each is of."""
    size = high - low
    of = np.repeat(np.arange(len(low)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[of], of
