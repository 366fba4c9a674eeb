"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Every word is read by a hashed vector of its own and by the mean vector of its character trigrams
(with word ends marked), so that words never seen in training are read by their spelling. Two
gated recurrent layers, one from either end, run over windows of `WINDOW` words; attention weighs
their states, and the weighted mean gives the window's logit. Windows overlap (`STRIDE` words
apart) and cover the whole text; the document's logit is that of its worst window, calibrated by
a logistic curve.

All of it is trained here in numpy, on a bounded sample of labelled rows: `SAMPLE_DOCS` of any
length drawn by hash. Those of up to `SAMPLE_CHARS` characters train whole, longer ones by a run of
that length at a place drawn by hash. Labels are of documents, so after some passes over random
windows each document is represented by the window that scores highest just then. The logistic
curve is fitted on the logits of whole texts, however long, which tasks compute.

Defined results: null, empty and wordless texts get the score of a window without words; repeated
rows get equal scores; null labels teach nothing; with labels of one kind only, or none, every
score is the share of label 1 (0.5 if there is none); an empty table gives an empty result; extra
columns are kept whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestdoc.llm._frames import quoted, table
from nestdoc.llm._recurrent import F32, Adam, gru, gru_back, gru_weights, sigmoid
from nestdoc.llm._words import ALNUM, LOWER, U64, chunks, mix, utf8, words

SAMPLE_DOCS = 4500
SAMPLE_CHARS = 6000
WINDOW, STRIDE = 48, 40
EPOCHS = 10
RATE = 0.006
#: In the later passes a label 1 that no window comes nearer to is taken for an error of labelling.
DOUBT = 0.8
#: One sampled row in so many is left out of training and calibrates the scores.
HOLD = 5
#: With fewer rows all of them train and calibrate.
FEW = 200
#: Few enough rows that rare words share them: the network cannot learn single texts by heart.
WORD_ROWS, TRIGRAM_ROWS = 1 << 12, 1 << 12
WORD_WIDTH, CHAR_WIDTH, HIDDEN = 8, 8, 8
CHUNK_BYTES = 1 << 20


@dataclass
class Read:
    """The distinct words of some texts, and every text's windows over them."""

    word: np.ndarray  # by distinct word: its row of word vectors
    trigram: np.ndarray  # rows of trigram vectors of all distinct words, one word after another
    begin: np.ndarray  # by distinct word: its first trigram
    count: np.ndarray  # and how many it has
    at: np.ndarray  # (steps, windows): distinct word at each step, 0 past the end
    mask: np.ndarray
    doc: np.ndarray  # by window


def read(column: pa.Array) -> Read:
    """Whole texts as overlapping windows; a text without words is one empty window."""
    data, offsets = utf8(column)
    w = words(data, offsets, ALNUM)
    distinct, first, at_word = np.unique(w.hashes, return_index=True, return_inverse=True)
    points = np.frombuffer(LOWER[data].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    leads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    low, high = leads[w.starts[first]], leads[w.ends[first]]
    size = high - low
    begin = np.cumsum(size) - size
    char = np.arange(size.sum()) - np.repeat(begin - low, size)
    of = np.repeat(np.arange(len(size)), size)
    ring = np.concatenate((points, np.zeros(1, np.uint32))).astype(U64)
    before = np.where(char > low[of], ring[char - 1], U64(1))
    after = np.where(char + 1 < high[of], ring[np.minimum(char + 1, len(points))], U64(2))
    trigram = (mix(before * U64(0x1FFFFF) * U64(0x1FFFFF) + ring[char] * U64(0x1FFFFF) + after) & U64(TRIGRAM_ROWS - 1)).astype(np.int64)
    counts = w.counts
    windows = np.maximum(1, -(-(counts - (WINDOW - STRIDE)) // STRIDE))
    doc = np.repeat(np.arange(len(counts)), windows)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)) * STRIDE
    left = np.minimum(counts[doc] - start, WINDOW)
    steps = np.arange(max(1, int(left.max()) if len(left) else 1))[:, None]
    mask = steps < left[None, :]
    place = np.where(mask, (w.first[doc] + start)[None, :] + steps, 0)
    at = at_word[place] if len(at_word) else place
    return Read((distinct & U64(WORD_ROWS - 1)).astype(np.int64), trigram, begin, size, at, mask, doc)


@dataclass
class Network:
    w: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None  # the score of everything, where nothing could be learned

    def vectors(self, r: Read) -> np.ndarray:
        """Input of each distinct word."""
        spelled = np.zeros((len(r.word), CHAR_WIDTH), F32)
        if len(r.trigram):
            spelled = np.add.reduceat(self.w["char"][r.trigram], r.begin, axis=0) / r.count[:, None].astype(F32)
        return np.concatenate((self.w["word"][r.word], spelled), axis=1)

    def logits(self, r: Read, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """Logit of each window."""
        v = self.vectors(r) if len(r.word) else np.zeros((1, WORD_WIDTH + CHAR_WIDTH), F32)
        sides = []
        for side in "fr":
            at_x = (v @ self.w[f"{side}x"] + self.w[f"{side}b"])[r.at]
            sides.append(gru({"h": self.w[f"{side}h"]}, at_x, r.mask, side == "r", keep))
        h = np.concatenate([out for out, _ in sides], axis=2)
        look = np.where(r.mask, h @ self.w["look"], F32(-30))
        look = np.exp(look - look.max(axis=0, initial=-30))
        share = np.where(r.mask, look, 0)
        share /= np.maximum(share.sum(axis=0), F32(1e-9))
        pooled = np.einsum("tb,tbh->bh", share, h, optimize=True)
        z = pooled @ self.w["out"] + self.w["bias"][0]
        return z, (v, [trace for _, trace in sides], h, share, pooled)

    def gradients(self, r: Read, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of the windows' labels y."""
        z, (v, traces, h, share, pooled) = self.logits(r, keep=True)
        dz = (sigmoid(z) - y).astype(F32) / F32(len(y))
        g = {"out": pooled.T @ dz, "bias": dz.sum(keepdims=True)}
        dpool = dz[:, None] * self.w["out"]
        dshare = np.einsum("bh,tbh->tb", dpool, h)
        dlook = share * (dshare - (share * dshare).sum(axis=0))
        g["look"] = np.einsum("tb,tbh->h", dlook, h)
        dh = share[:, :, None] * dpool + dlook[:, :, None] * self.w["look"]
        dv = np.zeros_like(v)
        seen = r.at[r.mask]
        for k, side in enumerate("fr"):
            g[f"{side}h"], dx = gru_back({"h": self.w[f"{side}h"]}, traces[k], dh[:, :, k * HIDDEN : (k + 1) * HIDDEN])
            dx = dx[r.mask]
            g[f"{side}x"] = v[seen].T @ dx
            g[f"{side}b"] = dx.sum(0)
            np.add.at(dv, seen, dx @ self.w[f"{side}x"].T)
        g["word"], g["char"] = np.zeros_like(self.w["word"]), np.zeros_like(self.w["char"])
        if len(r.word):
            np.add.at(g["word"], r.word, dv[:, :WORD_WIDTH])
            share_ = dv[:, WORD_WIDTH:] / r.count[:, None].astype(F32)
            np.add.at(g["char"], r.trigram, np.repeat(share_, r.count, axis=0))
        return g

    def worst(self, r: Read) -> tuple[np.ndarray, np.ndarray]:
        """For each text the window of the highest logit, and that logit."""
        z, _ = self.logits(r)
        order = np.lexsort((z, r.doc))
        last = np.flatnonzero(np.append(r.doc[order][1:] != r.doc[order][:-1], True))
        return order[last], z[order[last]]

    def scores(self, column: pa.Array) -> np.ndarray:
        """Score of each text."""
        if self.constant is not None:
            return np.full(len(column), self.constant)
        _, z = self.worst(read(column))
        return sigmoid(z.astype(np.float64) * self.scale + self.shift)


def _some(r: Read, windows: np.ndarray) -> Read:
    """The reading cut to some windows and the words in them."""
    at, mask = r.at[:, windows], r.mask[:, windows]
    used, inverse = np.unique(at[mask], return_inverse=True)
    new = np.zeros_like(at)
    new[mask] = inverse
    size = r.count[used] if len(r.count) else used
    begin = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(begin - (r.begin[used] if len(used) else used), size)
    return Read(r.word[used], r.trigram[place], begin, size, new, mask, r.doc[windows])


def fit(rows: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 0, spare: np.ndarray | None = None) -> Network:
    """Network of (text, label) rows; those of `spare` calibrate it."""
    rng = np.random.default_rng(seed)
    width = WORD_WIDTH + CHAR_WIDTH
    w = {
        "word": rng.normal(0, 0.1, (WORD_ROWS, WORD_WIDTH)).astype(F32),
        "char": rng.normal(0, 0.3, (TRIGRAM_ROWS, CHAR_WIDTH)).astype(F32),
        "look": rng.normal(0, 0.1, 2 * HIDDEN).astype(F32),
        "out": rng.normal(0, 0.3, 2 * HIDDEN).astype(F32),
        "bias": np.zeros(1, F32),
    }
    for side in "fr":
        w |= {side + k: v for k, v in gru_weights(rng, width, HIDDEN).items()}
    net = Network(w)
    y = np.array([label for _, label in rows], F32)
    if not len(y) or y.min() == y.max():
        net.constant = float(y.mean()) if len(y) else 0.5
        return net
    texts = pa.array([t for t, _ in rows], pa.large_string())
    cuts = np.array_split(np.arange(len(rows)), max(1, len(rows) // 500))
    parts = [(read(texts.take(pa.array(c))), y[c]) for c in cuts]
    spare = np.arange(len(rows)) % HOLD == 0 if spare is None else spare
    spare = spare & (len(rows) >= FEW)
    learns = [~spare[c] for c in cuts]
    adam = Adam(w, RATE)
    for epoch in range(epochs):
        for k in rng.permutation(len(parts)):
            r, labels = parts[k]
            if epoch < epochs // 2:  # one window of each text, drawn at random
                order = np.lexsort((rng.random(len(r.doc)), r.doc))
                chosen = order[np.append(True, r.doc[order][1:] != r.doc[order][:-1])]
            else:
                chosen, z = net.worst(r)
                chosen = chosen[(labels == 0) | (sigmoid(z) >= 1 - DOUBT)]
            chosen = rng.permutation(chosen[learns[k][r.doc[chosen]]])
            for at in range(0, len(chosen), 96):
                some = chosen[at : at + 96]
                adam.step(net.gradients(_some(r, some), labels[r.doc[some]]))
    z = np.concatenate([net.worst(r)[1] for r, _ in parts]).astype(np.float64)
    truth = np.concatenate([labels for _, labels in parts])
    apart = spare if spare.any() and truth[spare].min() != truth[spare].max() else ~spare
    net.scale, net.shift = _curve(z[apart], truth[apart])
    return net


def _curve(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve over the logits, by Newton steps with a small ridge, halved where they would overshoot."""
    z, y = z.astype(np.float64), y.astype(np.float64)
    start = np.array([1.0, 0.0])
    x = np.stack((z, np.ones_like(z)), axis=1)

    def loss(a: np.ndarray) -> float:
        return float((np.logaddexp(0, x @ a) - y * (x @ a)).sum() + 5e-4 * ((a - start) ** 2).sum())

    a = start
    for _ in range(30):
        p = sigmoid(x @ a)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2) * 1e-3
        step = np.clip(np.linalg.solve(h, x.T @ (p - y) + 1e-3 * (a - start)), -2, 2)
        while loss(a - step) > loss(a) and np.abs(step).max() > 1e-9:
            step = step / 2
        a = a - step
    return max(float(a[0]), 0.05), float(a[1])


def train(docs: DataFrame, labels: DataFrame, use: Column, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Network:
    """Network of a bounded sample of the labelled rows for which `use` (over the id) holds."""
    ids = labels.select(quoted(doc_id).alias("id"), quoted(label).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    drawn = ids.where(use).groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)
    drawn = drawn.withColumn("spare", F.pmod(F.xxhash64("id", F.lit(HOLD)), F.lit(HOLD)) == 0)
    rows = docs.select(quoted(doc_id).alias("d"), quoted(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    met = rows.join(F.broadcast(drawn), F.col("d") == F.col("id"))
    at = F.lit(1) + F.floor(F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) * F.pmod(F.xxhash64("id", "text"), F.lit(1000)) / 1000)
    pieces = met.select("id", F.substring("text", at.cast("int"), F.lit(SAMPLE_CHARS)).alias("text"), "label", "spare")
    some = sorted(pieces.limit(2 * SAMPLE_DOCS).collect())
    spare = np.array([r["spare"] for r in some], bool)
    net = fit([(r["text"], r["label"]) for r in some], spare=spare)
    if net.constant is None:
        apart = len(some) >= FEW and len({r["label"] for r in some if r["spare"]}) > 1
        whole = met.where("spare") if apart else met
        found = _logits(whole.select("text", "label"), net).limit(2 * SAMPLE_DOCS).collect()
        z, y = (np.array(x, np.float64) for x in zip(*sorted(map(tuple, found)), strict=True))
        net.scale, net.shift = _curve(z, y)
    return net


def _logits(texts: DataFrame, net: Network) -> DataFrame:
    """(logit, label) of each whole text."""
    shared = texts.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", CHUNK_BYTES):
            _, z = shared.value.worst(read(part.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(z.astype(np.float64)), part.column(1)], names=["logit", "label"])

    return texts.mapInArrow(run, "logit double, label int")


def score(docs: DataFrame, net: Network, text: str = "text", out: str = "score") -> DataFrame:
    """`docs` plus the score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text, CHUNK_BYTES):
            scores = shared.value.scores(part.column(part.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def held_out(doc_id: Column) -> Column:
    """Rows that teach nothing: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("id")))
    found = score(docs, net).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")
    return found.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
