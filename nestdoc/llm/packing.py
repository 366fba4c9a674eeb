"""Packing by lexical retrieval: documents that share rare tokens fill a window together.

Documents become token ids with an end id. Whole windows of long documents are sequences of
their own, cut where the document is tokenised. What is left (less than a window of each
document) is sorted by the smallest hash of its tokens, so that documents with many tokens in
common tend to lie close, and cut in shards of `SHARD_TOKENS`. Each shard is an inverted index
with BM25 scores (statistics of the shard): a seed document asks for its neighbours, those not
used yet fill its window from the best on, and the one that crosses the window's end is cut;
its rest is the next seed. What does not fill a window goes on to the next shard of the task, and
at the end of a task is cut into sequences whose lengths are powers of two, which need no
padding. So no sequence is padded at all.

A group of copies, or a third of the rows, is no single key: the sort is by (hash, place), and
shards have a bounded number of tokens. Tokens are written once to the shared folder, with each
row's place, so a task that runs again packs the same rows alike.

A tokenizer of words in lower case that drops white space (`word_bpe_49k.json`) sees every
distinct word once for each task, kept by a 64-bit hash of its bytes; a probe at the start
decides, and texts are encoded whole for others.

Defined results: a null or empty text is the end id alone; repeated rows and null ids are each
packed; an empty table gives an empty result. Only the id and the text are read; other columns
may be called anything.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestdoc.llm._frames import quoted, table
from nestdoc.llm._words import LOWER, NON_SPACE, chunks, hash_spans, mix, spread, utf8, words
from nestdoc.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
WINDOW = 2048
END = 1
#: Tokens in one index.
SHARD_TOKENS = 1 << 19
CHUNK_BYTES = 4 << 20
#: Words whose ids a task keeps before it starts anew.
KEPT_WORDS = 3_000_000
#: BM25's saturation and share of length.
K1, B = 1.2, 0.75

_MARK = "\x01"
#: Bytes that end a word without being part of a letter or a number: `.,;:!?)"`.
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b'.,;:!?)"')] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def _units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words cut before the marks that close them, which the tokenizer does as well: the bytes to
    read them from, starts and ends, and the word that each is of.

    A cut needs a letter or digit before it that is one byte, or two of Latin-1. Words of ASCII
    are read in lower case, as the tokenizer does first of all; but not next to a `<`, for the
    special tokens keep their case."""
    stop = ends.copy()
    for _ in range(3):
        stop -= _CLOSING[data[stop - 1]] & (stop - 1 > starts)
    final = data[stop - 1]
    latin = (data[np.maximum(stop - 2, 0)] == 0xC3) & (stop - 2 >= starts) & (final >= 0x80) & (final != 0x97) & (final != 0xB7)
    stop = np.where(_ALNUM[final] | latin, stop, ends)
    cut = stop < ends
    word = np.repeat(np.arange(len(starts)), 1 + cut)
    second = np.zeros(len(word), bool)
    second[1:] = word[1:] == word[:-1]
    low = np.where(second, stop[word], starts[word])
    high = np.where(second, ends[word], stop[word])
    odd = np.concatenate(([0], np.cumsum((data >= 0x80) | (data == 0x3C))))
    raw = odd[ends] > odd[starts]
    lower = LOWER[data]
    kept, _ = spread(starts[raw], ends[raw])
    lower[kept] = data[kept]
    return lower, low, high, word


#: Latin letters, each of which has one letter as its lower case.
_LATIN = re.compile("[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")


class Encoder:
    """Token ids of texts; of words one by one where the tokenizer allows it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if not os.path.isabs(path):
            import public_tokenizers

            path = public_tokenizers.path(path)
        self.inner = Tokenizer.from_file(path)
        self.mark = self._encode([_MARK])[0]
        suffix = getattr(self.inner.model, "end_of_word_suffix", None)
        tokens = self.inner.get_vocab()
        self.closes = np.zeros(max(tokens.values()) + 1, bool)
        if suffix:
            self.closes[[i for t, i in tokens.items() if t.endswith(suffix)]] = True
        probe = "One two,\tthree\n\x0b'fóur 5 <|6"
        alone = [i for ids in self._encode(probe.split()) for i in ids]
        self.by_words = len(self.mark) == 1 and self._encode([probe])[0] == alone
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes of words, sorted; where their ids are, and how many
        self.low = self.size = np.zeros(0, np.int64)
        self.kept = np.zeros(1 << 16, np.uint32)
        self.filled = 0
        self.sizes: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.inner.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, texts: list[str]) -> list[int]:
        """Ids of words, many at a time; their order in the kept ones. Words of plain letters are
        told apart by the tokens that end a word, others by a mark between them."""
        latin = [_LATIN.fullmatch(t) is not None for t in texts]
        plain = [k for k, x in enumerate(latin) if x]
        rest = [k for k, x in enumerate(latin) if not x]
        for k in range(0, len(plain), 1 << 14):
            part = plain[k : k + (1 << 14)]
            ids = np.array(self._encode([" ".join([texts[j] for j in part])])[0], np.uint32)
            stops = np.flatnonzero(self.closes[ids])
            if len(stops) == len(part):
                self.sizes.append(np.diff(stops, prepend=-1))
                self.ids.append(ids)
            else:
                self._learn_marked([texts[j] for j in part])
        self._learn_marked([texts[j] for j in rest])
        return plain + rest

    def _learn_marked(self, texts: list[str]) -> None:
        for k in range(0, len(texts), 1 << 14):
            part = texts[k : k + (1 << 14)]
            held = [_MARK in t for t in part]
            line = f" {_MARK} ".join("" if h else t for t, h in zip(part, held, strict=True))
            ids = np.array(self._encode([line])[0], np.uint32)
            stops = np.append(np.flatnonzero(ids == self.mark[0]), len(ids))
            sizes = np.diff(stops, prepend=-1) - 1
            ids = ids[ids != self.mark[0]]
            if any(held):  # a word with the mark in it is encoded alone
                own = [np.array(self._encode([t])[0], np.uint32) if h else None for t, h in zip(part, held, strict=True)]
                pieces = np.split(ids, np.cumsum(sizes)[:-1])
                pieces = [p if o is None else o for p, o in zip(pieces, own, strict=True)]
                ids, sizes = np.concatenate(pieces), np.array([len(p) for p in pieces])
            self.sizes.append(sizes)
            self.ids.append(ids)

    def _unknown(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the sorted hashes are not kept."""
        at = np.searchsorted(self.known, hashes)
        near = self.known[np.minimum(at, len(self.known) - 1)] if len(self.known) else ~hashes
        return np.flatnonzero(near != hashes)

    def _keep(self, hashes: np.ndarray) -> None:
        """Add the words that were learnt just now, given in that order."""
        ids, size = np.concatenate(self.ids), np.concatenate(self.sizes)
        self.ids, self.sizes = [], []
        while self.filled + len(ids) > len(self.kept):
            self.kept = np.concatenate((self.kept, np.zeros_like(self.kept)))
        self.kept[self.filled : self.filled + len(ids)] = ids
        low = self.filled + np.cumsum(size) - size
        self.filled += len(ids)
        known = np.concatenate((self.known, hashes))
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.low, self.size = np.concatenate((self.low, low))[order], np.concatenate((self.size, size))[order]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has."""
        if not self.by_words:
            found = self._encode([t or "" for t in column.to_pylist()])
            counts = np.array([len(f) for f in found], np.int64)
            return np.array([i for f in found for i in f], np.uint32), counts
        data, offsets = utf8(column)
        w = words(data, offsets, NON_SPACE, lower=False)
        data, starts, ends, word = _units(data, w.starts, w.ends)
        hashes, at, code = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > KEPT_WORDS:
            self._forget()
        new = self._unknown(hashes)
        if len(new):
            raw = data.tobytes()
            spans = zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)
            order = self._learn([raw[s:e].decode("utf-8", "replace") for s, e in spans])
            self._keep(hashes[new][order])
        k = np.searchsorted(self.known, hashes)
        low, size = self.low[k][code], self.size[k][code]
        members, _ = spread(low, low + size)
        counts = np.bincount(w.row[word], weights=size, minlength=len(offsets) - 1).astype(np.int64)
        return self.kept[members], counts


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One encoder for each path in a Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _sketch(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The smallest hash of each row's ids, none of them empty."""
    return (np.minimum.reduceat(mix(ids.astype(np.uint64) + np.uint64(1)), first) >> np.uint64(1)).astype(np.int64)


class Shard:
    """BM25 inverted index of some token sequences."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = n = len(rows)
        counts = np.array([len(r) for r in rows])
        row = np.repeat(np.arange(n), counts)
        terms, code = np.unique(np.concatenate(rows), return_inverse=True)
        keys, tf = np.unique(code.astype(np.int64) * n + row, return_counts=True)
        self.place, term = keys % n, keys // n
        df = np.bincount(term, minlength=len(terms))
        self.ends = np.cumsum(df)
        self.starts = self.ends - df
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * counts / counts.mean())
        self.scores = idf[term] * tf * (K1 + 1) / (tf + norm[self.place])
        by_row = np.argsort(self.place, kind="stable")
        self.terms = term[by_row]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(self.place, minlength=n))))

    def neighbours(self, k: int) -> np.ndarray:
        """The sequences that share a term with sequence k, the best first; equal ones by place."""
        terms = self.terms[self.first[k] : self.first[k + 1]]
        members, _ = spread(self.starts[terms], self.ends[terms])
        scores = np.bincount(self.place[members], weights=self.scores[members], minlength=self.n)
        order = np.argsort(-scores, kind="stable")
        return order[scores[order] > 0]


def fill(sizes: list[int], neighbours, window: int) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Windows of (row, start, length), each full, and the pieces of the last one, if not full."""
    used = [False] * len(sizes)
    following = 0
    rest: tuple[int, int] | None = None  # row and start of what the last window cut off
    windows: list[list[tuple[int, int, int]]] = []
    pieces: list[tuple[int, int, int]] = []
    room = window

    def add(row: int, start: int) -> None:
        nonlocal room, rest
        take = min(sizes[row] - start, room)
        pieces.append((row, start, take))
        room -= take
        rest = (row, start + take) if start + take < sizes[row] else None

    while True:
        if rest:
            seed, start = rest
        else:
            while following < len(sizes) and used[following]:
                following += 1
            if following == len(sizes):
                return windows, pieces
            seed, start = following, 0
            used[seed] = True
        add(seed, start)
        if room:
            for row in neighbours(seed):
                if not used[row]:
                    used[row] = True
                    add(int(row), 0)
                    if not room:
                        break
        if not room:
            windows.append(pieces)
            pieces, room = [], window


def powers(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces cut anew so that each list of them is a power of two long, the longest first."""
    left = sum(n for _, _, n in pieces)
    queue = list(reversed(pieces))
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            row, start, n = queue.pop()
            take = min(n, room)
            out.append((row, start, take))
            room -= take
            if take < n:
                queue.append((row, start + take, n - take))
        yield out


def tokenise(docs: DataFrame, doc_id: str, text: str, tokenizer: str, window: int, end: int) -> DataFrame:
    """Token ids of all documents, cut at whole windows and written to the shared folder."""
    spark = docs.sparkSession
    docs = docs.select(quoted(doc_id).alias("id"), quoted(text).alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", docs.schema["id"].dataType),
            *[T.StructField(n, T.LongType()) for n in ("place", "start", "length", "doc_tokens", "sketch")],
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        place = TaskContext.get().partitionId() << 33
        for part in chunks(batches, "text", CHUNK_BYTES):
            ids, counts = encoder.encode(part.column(1))
            ids = np.insert(ids, np.cumsum(counts), np.uint32(end))
            counts = counts + 1
            first = np.cumsum(counts) - counts
            n_pieces = -(-counts // window)
            k, row = spread(np.zeros(len(counts), np.int64), n_pieces)
            start = k * window
            length = np.minimum(counts[row] - start, window)
            at = first[row] + start
            raw = ids.astype("<u4" if len(ids) and ids.max() >> 16 else "<u2")
            body = [raw[a : a + n].tobytes() for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            columns = [
                part.column(0).take(pa.array(row)),
                pa.array(place + np.arange(len(row))),
                pa.array(start),
                pa.array(length),
                pa.array(counts[row]),
                pa.array(_sketch(ids, at)),
                pa.array(body, pa.binary()),
            ]
            place += len(row)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    path = scratch_path(spark, "packing-tokens")
    docs.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _ids(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    window: int = WINDOW,
    end: int = END,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row for each piece of a document: its id, `start` and `length` in the document's ids,
    `doc_tokens` (all of them, with the end id), `ids` (little-endian 32-bit), the sequence
    that it lies in and its `offset` there. `tokenizer` is a path, or a name among the public
    tokenizers."""
    tokens = tokenise(docs, doc_id, text, tokenizer, window, end)
    schema = T.StructType(
        [
            T.StructField(doc_id, tokens.schema["id"].dataType),
            *[T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")],
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def batch(kind: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:6]), pa.array(columns[6], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for k in range(0, part.num_rows, 1 << 10):
                rows = part.slice(k, 1 << 10).to_pylist()
                out = [
                    (r["id"], r["start"], window, r["doc_tokens"], 2 * r["place"], 0, _ids(r["ids"], window).tobytes())
                    for r in rows
                ]
                if out:
                    yield batch(part.schema.field("id").type, out)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        held: list[tuple] = []  # (id, start, doc_tokens, ids)
        kind, total = pa.null(), 0

        def sequences(lists) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            out = []
            for pieces in lists:
                at = 0
                for k, start, n in pieces:
                    name, before, doc_tokens, ids = held[k]
                    out.append((name, before + start, n, doc_tokens, 2 * sequence + 1, at, ids[start : start + n].tobytes()))
                    at += n
                sequence += 1
                if len(out) >= 1 << 10:
                    yield batch(kind, out)
                    out = []
            if out:
                yield batch(kind, out)

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, total
            shard = Shard([h[3] for h in held])
            windows, left = fill([len(h[3]) for h in held], shard.neighbours, window)
            yield from sequences(windows)
            if final:
                yield from sequences(powers(left))
            kept = [(held[k][0], held[k][1] + s, held[k][2], held[k][3][s : s + n]) for k, s, n in left]
            held, total = kept, sum(len(h[3]) for h in kept)

        for part in batches:
            kind = part.schema.field("id").type
            for k in range(0, part.num_rows, 1 << 10):
                for r in part.slice(k, 1 << 10).to_pylist():
                    held.append((r["id"], r["start"], r["doc_tokens"], _ids(r["ids"], r["length"])))
                    total += r["length"]
                    if total >= shard_tokens:
                        yield from flush(False)
        if held:
            yield from flush(True)

    full = tokens.where(F.col("length") == window)
    part = tokens.where(F.col("length") < window).repartitionByRange("sketch", "place").sortWithinPartitions("sketch", "place")
    return full.mapInArrow(whole, schema).unionByName(part.mapInArrow(rest, schema))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
