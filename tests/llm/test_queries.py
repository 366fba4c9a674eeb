"""Registered queries against their SQL, and the pipeline against its stages done plainly."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from nestdoc.llm import queries

from ..conftest import SF001
from ..test_oracle import bag
from .helpers import alnum, spaced
from .test_jaccard import brute as near
from .test_suffixes import brute as repeats

TABLES = "documents pages benchmark labels conversations".split()


def test_all_are_registered():
    names = E.queries()
    numbers = {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))}
    assert numbers == set(range(1, 14)) and "pipeline" in names
    assert set(queries.SQL) < set(queries.QUERIES) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t + '.parquet')}')")
    df = E.queries()[name](spark, SF001)
    res = con.execute(queries.SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert bag(df.columns, df.collect()) == bag(cols, res.fetchall())


def stage(spark, k, rows, columns, tmp):
    df = spark.createDataFrame(rows, columns) if not hasattr(rows, "columns") else rows
    out = corpus_pipeline.STAGES[k][1](spark, df, SF001)
    path = os.path.join(tmp, str(k))
    out.write.parquet(path)
    return spark.read.parquet(path)


def test_pipeline_like_its_stages_done_plainly(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    # 1: documents with a letter stay
    out = stage(spark, 0, docs, None, tmp_dir)
    rows = {i: t for i, t in rows.items() if any(c.isalpha() for c in t or "")}
    assert out.columns == columns and {r["doc_id"] for r in out.collect()} == set(rows)
    # 2: the smallest id of each group of near copies stays
    out = stage(spark, 1, out, None, tmp_dir)
    rows = {i: rows[i] for i in {c for _, n, c in near(list(rows.items()), 5, 80)}}
    assert out.columns == columns and {r["doc_id"] for r in out.collect()} == set(rows)
    # 3: passages that an earlier document has are cut
    out = stage(spark, 2, out, None, tmp_dir)
    gone = {}
    for i, _, s, e in repeats(list(rows.items()), 50):
        gone.setdefault(i, set()).update(range(s, e))
    left = {i: [w for k, w in enumerate(spaced(t)) if k not in gone.get(i, ())] for i, t in rows.items()}
    left = {i: w for i, w in left.items() if w or not spaced(rows[i])}
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == columns and {i: spaced(t) for i, t in got.items()} == left
    # 4: documents that share a window with a benchmark item go
    out = stage(spark, 3, out, None, tmp_dir)
    windows = set()
    for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect():
        w = alnum(r["text"])
        n = min(10, len(w))
        windows |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1) if w}
    sizes = {len(x) for x in windows}

    def clean(t):
        w = alnum(t)
        return not any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    got = {i: t for i, t in got.items() if clean(t)}
    assert out.columns == columns and {r["doc_id"]: r["text"] for r in out.collect()} == got
    # 5: a mix of the rest
    out = stage(spark, 4, out, None, tmp_dir)
    taken = {r["doc_id"]: r["copies"] for r in out.collect()}
    assert out.columns == [*columns, "copies"] and set(taken) <= set(got) and set(taken.values()) <= {1, 2, 3}
    total = sum(len(spaced(t)) for t in got.values())
    assert abs(sum(c * len(spaced(got[i])) for i, c in taken.items()) - total) < 0.15 * total
    final = corpus_pipeline.run(spark, SF001)
    assert sorted((r["doc_id"], r["copies"]) for r in final.collect()) == sorted(taken.items())


def test_pipeline_of_odd_and_empty_tables(spark, tmp_dir):
    import random

    from .helpers import SCHEMA, odd_rows

    benchmark = spark.read.parquet(f"{SF001}/benchmark.parquet")
    benchmark.write.parquet(os.path.join(tmp_dir, "benchmark.parquet"))
    for name, rows in (("odd", odd_rows(random.Random(1))), ("none", [])):
        df = spark.createDataFrame([(*r, len(r[1] or ""), "z") for r in rows], SCHEMA + ", n_chars long, copies string")
        for k, (step, f) in enumerate(corpus_pipeline.STAGES):
            out = f(spark, df, tmp_dir)
            path = os.path.join(tmp_dir, f"{name}-{k}")
            out.write.parquet(path)
            out = spark.read.parquet(path)
            assert k == 4 or out.columns == df.columns
            df = out
        assert df.columns[-1] == "_copies"
