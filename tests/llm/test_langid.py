import random
import zlib

import numpy as np
import pyarrow as pa

from nestdoc.llm import langid as L

from ..conftest import SF01
from .helpers import SCHEMA, odd_rows


def plain_phrases(train, s):
    """Phrases by looking for ever longer pieces."""
    count, at = 0, 0
    while at < len(s):
        n = 0
        while at + n < len(s) and s[at : at + n + 1] in train:
            n += 1
        at += max(n, 1)
        count += 1
    return count


def test_parse_like_searching(monkeypatch):
    monkeypatch.setattr(L, "STRETCH", 37)
    rng = random.Random(1)
    train = bytes(rng.randrange(4) for _ in range(200))
    table = L.parse_table(L.suffix_automaton(list(train)), 5)
    model = L.LanguageModel(["x"], np.zeros(1), 5, [table], [1.0])
    texts = [bytes(rng.choice([0, 1, 2, 3, 3, 4]) for _ in range(n)) for n in (0, 1, 36, 37, 38, 300)]
    s = np.frombuffer(b"".join(texts), np.uint8)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got, size = L.phrases(model, s, row, len(texts))
    want = [sum(plain_phrases(train, t[k : k + 37]) for k in range(0, len(t), 37)) for t in texts]
    assert got[0].tolist() == want and size.tolist() == [len(t) for t in texts]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = L.op10_language_id(spark, SF01).collect()
    assert {r["doc_id"] for r in rows} == set(truth)
    held = [r for r in rows if r["held_out"]]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["held_out"] for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.95 * len(held) > 100


def test_odd_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(*r, "x") for r in odd_rows(random.Random(1))], SCHEMA + ", symbol_of string")
    model = L.train(df)
    assert model.languages == ["de", "en", "fr"] or model.languages == ["en", "fr"]
    out = L.identify(df, model).collect()
    for r in out:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not lettered)
        assert lettered or r["score"] == 0
    none = spark.createDataFrame([], SCHEMA)
    assert L.identify(none, model).count() == 0
    assert {r["lang_pred"] for r in L.identify(df, L.train(none)).collect()} == {"und"}


def test_one_language_and_ties():
    one = L.fit([("en", "some plain words of a text here")])
    langs, score = L.predict(one, pa.array(["some words", None]))
    assert langs == ["en", "und"] and score.tolist() == [1.0, 0.0]
    two = L.fit_all([("b", "same text"), ("a", "same text")])
    langs, score = L.predict(two, pa.array(["same text"]))
    assert langs == ["a"] and score[0] == 0
