"""Periodic runs against a brute force over all lags."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from nestdoc.llm import periods

from ..conftest import SF001
from .helpers import SCHEMA, odd_rows, prose


def plain_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w, least=12):
    """Every maximal stretch of each lag; of equal stretches the smallest lag."""
    found = {}
    for p in range(1, len(w) // 2 + 1):
        k = 0
        while k < len(w) - p:
            if w[k] != w[k + p]:
                k += 1
                continue
            s = k
            while k < len(w) - p and w[k] == w[k + p]:
                k += 1
            if k - s >= p:
                found.setdefault((s, k - s + p), p)
    return sorted((s, n, p) for (s, n), p in found.items() if n >= max(least, 2 * p))


def core(texts, short=periods.SHORT, least=12):
    codes, first = [], [0]
    for w in texts:
        codes += w
        first.append(len(codes))
    hashes = periods.mix(np.array([zlib.crc32(str(c).encode()) for c in codes], np.uint64))
    got = periods.runs_of(hashes, np.array(first), short)
    out = [[] for _ in texts]
    for r, s, n, p in got.T.tolist():
        if n >= max(least, 2 * p):
            out[r].append((s, n, p))
    return out


def sequences(rng):
    fib = ["a"], ["a", "b"]
    while len(fib[1]) < 700:
        fib = fib[1], fib[1] + fib[0]
    morse = [bin(k).count("1") % 2 for k in range(1024)]
    yield from (list(fib[1]), morse, ["x"] * 500, [], ["a"], ["a"] * 12)
    for k in (7, 20, 63):
        ab = (["a", "b"] * k + ["a"]) * 2
        yield from (ab, ab + ["c"] + ab, ["z"] * 100 + ["y"] * k + ["z"] * 100, (["a"] * 100 + ["b"]) * 5)
    for _ in range(60):
        n, alphabet = rng.randrange(2, 400), rng.choice([2, 3, 5, 300])
        w = [rng.randrange(alphabet) for _ in range(n)]
        for _ in range(rng.randrange(4)):
            a = rng.randrange(n)
            p = rng.randrange(1, 90)
            for i in range(a, min(n, a + rng.randrange(2 * p, 5 * p))):
                w[i] = w[a + (i - a) % p] if a + (i - a) % p < n else w[i]
        yield w


@pytest.mark.parametrize("short", [4, 16])
def test_core_like_brute_force(short):
    texts = list(sequences(random.Random(5)))
    for w, got in zip(texts, core(texts, short), strict=True):
        assert got == brute(w), (len(w), w[:40])


def test_long_repetitions_take_no_square():
    n = 200_000
    rng = random.Random(2)
    unit = [rng.randrange(10**6) for _ in range(1234)]
    texts = [["a"] * n, [0, 1] * n, unit * 100, (["a"] * 5000 + ["b"]) * 20]
    got = core(texts)
    assert got[0] == [(0, n, 1)] and got[1] == [(0, 2 * n, 2)] and got[2] == [(0, 123400, 1234)]
    assert (0, 5001 * 20, 5001) in got[3] and len(got[3]) > 20


def expected(w):
    runs = brute(w)
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return runs, " ".join(x for i, x in enumerate(w) if i not in dropped)


def test_query_like_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in periods.op11_periodic_runs(spark, SF001).collect()}
    assert set(got) == {r["doc_id"] for r in docs}
    some = 0
    for r in docs:
        w = plain_words(r["text"])
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i if i < a else a + (i - a) % p] for i in range(len(w))]
        if len(w) > 3000:
            continue  # brute force is quadratic; long texts are checked above
        runs, text = expected(w)
        x = got[r["doc_id"]]
        top = min(runs, key=lambda t: (-t[1], t[0], t[2]), default=(None, None, None))
        assert x["n_runs"] == len(runs)
        assert (x["start"], x["length"], x["period"]) == tuple(top)
        assert x["exponent_milli"] == (1000 * top[1] // top[2] if runs else None)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert x["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert x["collapsed_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        some += bool(runs)
    assert some > 10


def test_odd_rows_names_and_empty_table(spark):
    rng = random.Random(3)
    unit = prose(rng, 30)
    rows = [*odd_rows(rng), (20, " ".join([unit] * 3), "en", "a"), (20, " ".join([unit] * 3), "en", "a")]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA + ", periodic string, `a.b` string, c0 string")
    out = periods.find_runs(df)
    assert out.columns == [*df.columns, "_periodic"]
    got = out.collect()
    assert len(got) == len(rows) and all(r["a.b"] == "y" and r["c0"] == "z" for r in got)
    for r in got:
        runs, text = expected(plain_words(r["text"])) if len(r["text"] or "") < 10**4 else ([(0, 20000, 5)], None)
        assert [tuple(x) for x in r["_periodic"]["runs"]] == runs
        assert text is None or r["_periodic"]["collapsed"] == text
    assert sorted(len(r["_periodic"]["runs"]) for r in got if r["doc_id"] == 20) == [1, 1]
    assert periods.find_runs(df.limit(0)).count() == 0
