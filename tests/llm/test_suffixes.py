import random

import pytest

from nestdoc.llm import suffixes as S

from .helpers import SCHEMA, odd_rows, prose, spaced


def brute(rows, n):
    """Spans as the operator states them: rows of (id, text) are documents, in order of id."""
    docs = sorted({(i, t) for i, t in rows if len(spaced(t)) >= n}, key=lambda d: (d[0] is not None, d[0] or 0))
    heads, out = {}, []
    first = {}
    for i, t in docs:
        if t in heads and heads[t] != i:
            out.append((i, heads[t], 0, len(spaced(t))))
            continue
        heads.setdefault(t, i)
        w, runs = spaced(t), {}
        for s in range(len(w) - n + 1):
            key = tuple(w[s : s + n])
            if key in first:
                runs.setdefault(first[key], []).append(s)
            else:
                first[key] = i
        for f, starts in runs.items():
            begin = last = starts[0]
            for s in starts[1:] + [None]:
                if s is None or s - last > n:
                    out.append((i, f, begin, last + n))
                    begin = s
                last = s
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [12, 50])
def test_like_brute_force(spark, monkeypatch, n):
    monkeypatch.setattr(S, "CHUNK_BYTES", 4000)
    rng = random.Random(n)
    passages = [prose(rng, rng.choice([11, 13, 49, 50, 51, 90])) for _ in range(8)]
    rows = []
    for k in range(70):
        parts = [prose(rng, rng.choice([0, 3, 30]), 10**6) for _ in range(3)]
        text = " ".join([parts[0], rng.choice(passages), parts[1], rng.choice(passages).upper(), parts[2]])
        rows.append((k, text))
    rows += [(200, "again and " * 40), (201, "again and " * 60), (202, rows[3][1]), (203, rows[3][1]), (5, rows[5][1])]
    rows += [(300 + r[0] if r[0] is not None else None, r[1]) for r in odd_rows(rng)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.repeated_passages(df, min_words=n).collect()
    assert sorted(((r["id"], r["first_id"], r["start"], r["end"]) for r in got), key=repr) == brute(rows, n)


def test_repeats_are_cut_and_others_stay(spark):
    rng = random.Random(4)
    passage, a, b = prose(rng, 60), prose(rng, 30), prose(rng, 30)
    rows = [
        (1, f"{a} {passage}", 5, "x"),
        (2, f"Head\n{passage}  tail {b}", 5, "y"),
        (3, passage, 5, None),
        (4, None, 0, "z"),
        (5, "", 0, "z"),
        (6, f"{a} {passage}", 5, "copy"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, cuts string")
    out = S.remove_repeats(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert sorted(got) == [1, 2, 4, 5]  # 3 and 6 had no other words
    assert got[1]["text"] == rows[0][1] and got[2]["text"] == f"Head\ntail {b}"
    assert got[2]["n_chars"] == len(got[2]["text"]) and got[2]["cuts"] == "y"


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert S.repeated_passages(none).count() == 0 and S.remove_repeats(none).count() == 0
    with pytest.raises(ValueError):
        S.repeated_passages(none, min_words=3)
