"""What a Python task of the pipeline's text stages holds beside its batch."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa

from nestdoc.llm import _words as W
from nestdoc.llm import decontaminate as D
from nestdoc.llm import jaccard as J
from nestdoc.llm import suffixes as S


def texts(n_bytes, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=rng.randint(2, 9))) for _ in range(5000)]
    rows, size = [], 0
    while size < n_bytes:
        rows.append(" ".join(rng.choices(vocabulary, k=400)))
        size += len(rows[-1])
    return pa.array(rows, pa.string())


def peak_mb(f):
    W._POWERS.clear()
    tracemalloc.start()
    try:
        f()
        return tracemalloc.get_traced_memory()[1] / (1 << 20)
    finally:
        tracemalloc.stop()


def test_a_shard_of_the_suffix_arrays_is_small():
    items = D.needles([("a", " ".join(texts(3000, 2).to_pylist()))], 10)
    text = texts(D.SHARD_BYTES)
    assert peak_mb(lambda: D.match(text, items)) < 64


def test_chunks_of_near_copies_and_passages_are_small():
    text = texts(J.CHUNK_BYTES)
    assert peak_mb(lambda: J.ngram_sets(text, J.N)) < 32
    text = texts(S.CHUNK_BYTES)
    assert peak_mb(lambda: S.anchors(W.words(*W.utf8(text), W.NON_SPACE), S.MIN_WORDS)) < 32


def test_shards_follow_the_benchmark():
    assert [D.shard_size(n) for n in (0, 100, 3 << 20, 1 << 40)] == [D.SHARD_BYTES, D.SHARD_BYTES, 3 << 20, D.MOST_SHARD_BYTES]
