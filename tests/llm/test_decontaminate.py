import hashlib
import random

import pytest

from nestdoc.llm import decontaminate as D

from .helpers import SCHEMA, alnum, odd_rows, prose


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = alnum(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w = alnum(text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((doc_id, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


def run(spark, docs, items, **options):
    df = spark.createDataFrame([(d, t) for d, t in docs], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.find_matches(df, bench, **options).collect()
    out = []
    for r in rows:
        m = r["matches"]
        out.append((r["doc_id"], m["n_words"], sum(e - s for s, e in zip(m["starts"], m["ends"])), tuple(sorted(m["items"]))))
        assert (m["longest"] > 0) == bool(m["items"])
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [8 << 20, 700])
def test_like_brute_force(spark, block_bytes):
    rng = random.Random(3)
    items = [(k, prose(rng, rng.choice([0, 1, 3, 9, 10, 25, 60]), 40)) for k in range(25)]
    items += [(3, prose(rng, 30)), (99, items[7][1]), (None, "a null id here"), (50, None), (51, "")]
    docs = [(k, prose(rng, rng.choice([0, 5, 40, 200]), 40)) for k in range(40)]
    for k in range(100, 130):
        words = alnum(rng.choice(items)[1])
        cut = " ".join(words[rng.randrange(0, 3) :])
        docs.append((k, f"{prose(rng, 20)} {cut.upper()}, {cut}. {prose(rng, 5)}"))
    docs += [(r[0], r[1]) for r in odd_rows(rng)] + [(7, "x A null. ID here y")]
    assert run(spark, docs, items, block_bytes=block_bytes, shard_bytes=900) == brute(docs, items)


def test_longest_match_and_spans(spark):
    rng = random.Random(5)
    item = prose(rng, 40)
    words = item.split()
    doc = " ".join(["q"] * 7 + words[5:33] + ["r"] * 4)
    df = spark.createDataFrame([(1, doc)], "doc_id long, text string")
    m = D.find_matches(df, spark.createDataFrame([(9, item)], "item_id long, text string")).first()["matches"]
    assert (m["starts"], m["ends"], m["longest"], m["items"]) == ([7], [35], 28, ["9"])


def test_empty_tables_and_other_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([(1, "some words of an item that is long enough to be one window")], "item_id long, text string")
    assert D.find_matches(none, items).count() == 0
    docs = spark.createDataFrame([(1, items.first()["text"], 5, "x"), (2, "clean", 6, None)], "doc_id long, text string, matches int, n_words string")
    assert [tuple(r) for r in D.remove_contaminated(docs, items).collect()] == [(2, "clean", 6, None)]
    assert D.remove_contaminated(docs, items).columns == docs.columns
    assert D.remove_contaminated(docs, items.limit(0)).count() == 2


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
