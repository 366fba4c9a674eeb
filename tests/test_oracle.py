"""Every registered query against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

import collections
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from nestdoc import catalog, oracle

from .conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t + '.parquet')}')")
    return c


def norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return v


def bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(norm(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(oracle.SQL) == set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert bag(df.columns, df.collect()) == bag(cols, res.fetchall())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


STAGES = [
    "claims_with_payments", "receipts_by_policy", "tariffs_by_policy", "clients_with_accounts",
    "policy_core", "participants_by_policy", "nest_two_level", "policy_document",
]


@pytest.mark.parametrize("name", STAGES)
def test_stage_queries_with_tiny_pages_match_sql(spark, con, name, monkeypatch):
    from nestdoc.plans.spec import BuildOptions

    monkeypatch.setattr(catalog, "BOUNDED", BuildOptions(max_items=2))
    monkeypatch.setattr(catalog, "DEFAULT_MAX_ITEMS", 2)
    df = catalog.QUERIES[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert bag(df.columns, df.collect()) == bag(cols, res.fetchall())
