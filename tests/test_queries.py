"""Every registered query against its DuckDB oracle, on the smallest shared tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from stellate.plans.oracle import ORACLE
from stellate.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    return v.isoformat() if hasattr(v, "isoformat") else v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, df.collect()) == _bag(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["tbl", "inserted", "updated", "total_after"]
    assert df.count() == 4
