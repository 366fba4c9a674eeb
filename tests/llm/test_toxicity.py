import random
import zlib

import numpy as np
import pyarrow as pa

from nestdoc.llm import toxicity as X

from .helpers import SCHEMA, odd_rows, prose


def labelled(rng, n):
    rows = []
    for _ in range(n):
        words = prose(rng, rng.choice([30, 80, 200]), 500).split()
        bad = rng.random() < 0.3
        if bad:
            for _ in range(max(2, len(words) // 25)):
                words[rng.randrange(len(words))] = rng.choice(["idiot", "scumbag", "morons"])
        rows.append((" ".join(words), int(bad)))
    return rows


def test_held_out_texts():
    rng = random.Random(1)
    net = X.fit(labelled(rng, 500))
    rest = labelled(rng, 300)
    s = net.scores(pa.array([t for t, _ in rest]))
    y = np.array([label for _, label in rest])
    assert ((s >= 0.7) == y).mean() > 0.95
    # unseen spellings are near those seen, and one bad window in a long text counts
    long = prose(rng, 3000, 500)
    a, b = net.scores(pa.array([long, f"{long} you idiot moron scum idiots {long}"]))
    assert a < 0.7 <= b


def test_gradients():
    rng = random.Random(2)
    rows = labelled(rng, 4)
    net = X.fit(rows, epochs=0)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    r = X.read(pa.array([t for t, _ in rows] + [""]))
    some = X._some(r, np.arange(len(r.doc)))
    y = np.array([*[label for _, label in rows], 1.0])[r.doc]

    def loss():
        z, _ = net.logits(some)
        return (np.logaddexp(0, z) - y * z).mean()

    g = net.gradients(some, y)
    pick = np.random.default_rng(0)
    for k in net.w:
        places = np.argwhere(np.abs(g[k]) > np.abs(g[k]).max() * 0.3)
        i = tuple(places[pick.integers(len(places))])
        net.w[k][i] += 1e-3
        more = loss()
        net.w[k][i] -= 2e-3
        less = loss()
        net.w[k][i] += 1e-3
        assert abs((more - less) / 2e-3 - g[k][i]) < 0.05 * abs(g[k][i]) + 1e-4, k


def test_windows_cover_whole_texts():
    text = prose(random.Random(3), 500)
    r = X.read(pa.array([text, "", None, "one"]))
    assert [int((r.doc == k).sum()) for k in range(4)] == [-(-(500 - 8) // 40), 1, 1, 1]
    assert int(r.mask[:, r.doc == 1].sum()) == 0
    assert len(np.unique(r.at[:, r.doc == 0][r.mask[:, r.doc == 0]])) == len(set(text.split()))


def test_odd_rows_and_tables_without_labels(spark):
    df = spark.createDataFrame([(*r, "y") for r in odd_rows(random.Random(4))], SCHEMA + ", logit string")
    labels = spark.createDataFrame([(1, 1), (7, 0), (8, None), (None, 1), (1, 1)], "doc_id long, toxic int")
    net = X.fit([])
    out = X.score(df, net).collect()
    assert len(out) == df.count() and {r["score"] for r in out} == {0.5}
    assert X.fit([("a b", 1), ("c", 1)]).constant == 1.0
    assert X.score(df.limit(0), net).count() == 0
    from pyspark.sql import functions as F

    trained = X.train(df, labels, F.col("id") < 8)
    scores = [r["score"] for r in X.score(df, trained).collect()]
    assert all(0 <= s <= 1 for s in scores)


def test_held_out_rows(spark):
    from pyspark.sql import functions as F

    rows = spark.range(50).select("id", X.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)


def test_labelled_texts_that_are_all_long(spark):
    rng = random.Random(5)
    rows = []
    for k in range(800):
        words = prose(rng, rng.choice([1600, 2000]), 500).split()
        if bad := int(rng.random() < 0.4):
            for _ in range(len(words) // 20):
                words[rng.randrange(len(words))] = rng.choice(["idiot", "scumbag", "morons"])
        rows.append((k, " ".join(words), bad))
    assert min(len(t) for _, t, _ in rows) > X.SAMPLE_CHARS
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    from pyspark.sql import functions as F

    net = X.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"), F.col("id") < 600)
    got = X.score(df.where("doc_id >= 600"), net).collect()
    assert net.constant is None
    assert sum((r["score"] >= 0.7) == r["toxic"] for r in got) > 0.95 * len(got)
    # logits of whole texts calibrate: a bad window far from any piece's place counts
    long = prose(rng, 20000, 500)
    z = [r["logit"] for r in X._logits(spark.createDataFrame([(long, 0), (f"{long} you idiot moron scumbag idiot", 1)], "text string, label int").coalesce(1), net).collect()]
    assert z[1] > z[0]


def test_curve_of_noisy_labels():
    pick = np.random.default_rng(0)
    y = np.arange(900) % 2
    z = np.where(y > 0, pick.normal(6, 1, 900), pick.normal(-6, 1, 900))
    flip = pick.random(900) < 0.05
    a, b = X._curve(z, np.where(flip, 1 - y, y))
    assert 0.4 < a < 0.6 and abs(b) < 0.5
