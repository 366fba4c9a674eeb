import random
import re

from nestdoc.llm import quality as Q

from ..conftest import SF01
from .helpers import SCHEMA, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeat = {p + d for at in windows.values() if len(at) > 1 for p in at for d in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeat))


def test_statistics_like_plain_code(spark):
    rng = random.Random(1)
    rows = odd_rows(rng) + [(50 + k, "\n".join(prose(rng, rng.randrange(6), 3) for _ in range(rng.randrange(9))), "en", "a") for k in range(60)]
    rows += [(200, "a b c a b c\na b\n\na b", "en", "a"), (201, "x x x x", "en", "a"), (202, "# a|b <c> $%&*", "en", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in Q.text_statistics(df).drop("lang", "source").collect()]
    assert sorted(got, key=repr) == sorted(((r[0], *plain(r[1])) for r in rows), key=repr)


def test_junk_is_rejected_and_clean_texts_stay(spark):
    rng = random.Random(2)
    rows = []
    for k in range(600):
        text = ". ".join(prose(rng, 12, 4000) for _ in range(rng.randrange(6, 40)))
        if k % 20 == 0:
            text = " ".join(w + "###" for w in text.split())
        rows.append((k, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", None])))
    out = Q.quality_verdicts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["doc_id"] for r in out if not r["kept"]} == {k for k in range(600) if k % 20 == 0}


def test_labels_of_the_tables(spark):
    out = {r["doc_id"]: r for r in Q.op4_quality_rules(spark, SF01).collect()}
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    good = [out[d] for d, q in quality.items() if q == 1 and d in out and not out[d]["base_failed"]]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good) > 100
    assert not any(r["kept"] for r in out.values() if r["base_failed"])


def test_odd_rows_and_empty_table(spark):
    df = spark.createDataFrame([(*r, 1) for r in odd_rows(random.Random(3))], SCHEMA + ", grp int")
    out = Q.quality_verdicts(df).collect()
    assert len(out) == df.count() and all(r["kept"] is not None for r in out)
    assert all(r["base_failed"] and not r["kept"] for r in out if r["n_words"] < 50)
    assert Q.quality_verdicts(spark.createDataFrame([], SCHEMA)).count() == 0
