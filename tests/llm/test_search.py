"""Ranked search against a brute force that scores every document."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from nestdoc.llm import search

from .helpers import SCHEMA, alnum, odd_rows, prose


def brute(docs, items, k=10):
    counts = [Counter(alnum(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for (i, _), c, size in zip(docs, counts, sizes, strict=True):
            score = 0
            for t in set(alnum(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                m = 10 + (90 * size * n) // total
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


def texts(rng, n):
    copy = prose(rng, 50, 200)
    return [(k, copy if k % 3 == 0 else prose(rng, rng.randrange(1, 120), 400)) for k in rng.sample(range(10**6), n)]


@pytest.mark.parametrize("shard_bytes,short_share,block_bytes", [(1 << 20, 8, 1 << 20), (2000, 2, 1 << 20), (5000, 100, 700)])
def test_like_brute_force(spark, shard_bytes, short_share, block_bytes):
    rng = random.Random(shard_bytes)
    docs = texts(rng, 300)
    items = [(f"i{k}", prose(rng, rng.randrange(1, 40), 500)) for k in range(30)] + [("i0", "w1 w2"), ("none", "zzz")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    index = search.build_index(df, shard_bytes=shard_bytes)
    got = search.search(
        index, spark.createDataFrame(items, "item_id string, text string"), short_share=short_share, block_bytes=block_bytes
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got) == brute(docs, items)


def test_skipping_loses_no_document():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n, lists = int(rng.integers(1, 300)), int(rng.integers(1, 9))
        members = [np.sort(rng.choice(n, int(rng.integers(1, n + 1)), replace=False)) for _ in range(lists)]
        scores = [rng.integers(1, int(rng.choice([3, 100])), len(m)) for m in members]
        borders = np.concatenate(([0], np.cumsum([len(m) for m in members])))
        s = search.Lists(
            n, np.arange(lists), borders, np.concatenate(members), np.concatenate(scores), np.array([x.max() for x in scores])
        )
        sums = np.zeros(n, np.int64)
        for m, x in zip(members, scores, strict=True):
            sums[m] += x
        least, k = int(rng.integers(1, 120)), int(rng.integers(1, 8))
        want = [i for i in np.lexsort((np.arange(n), -sums)) if sums[i] >= least][:k]
        places, values = search.best_of_shard(s, np.arange(lists), least, k, int(rng.integers(0, n)), int(rng.integers(1, 99)))
        assert places.tolist() == want and values.tolist() == sums[want].tolist()


def test_odd_rows_names_and_empty_tables(spark):
    docs = odd_rows(random.Random(3))
    df = spark.createDataFrame([(*r, "x", 1.5) for r in docs], SCHEMA + ", score string, `a.b` double")
    unnamed = next(r[1] for r in docs if r[0] is None and r[1])
    items = [(5, " ".join(unnamed.split()[:5])), (1, "w1 w2 one LOREM ünï"), (1, "one"), (2, None), (3, ""), (None, "words two"), (4, "--- ...")]
    queries = spark.createDataFrame(items, "item_id long, text string")
    got = rows(search.search(search.build_index(df), queries))
    assert got == brute([(r[0], r[1]) for r in docs], [x for x in items if x[1]])
    assert any(r[2] is None for r in got)
    assert rows(search.search(search.build_index(df.limit(0)), queries)) == []
    assert rows(search.search(search.build_index(df), queries.limit(0))) == []
