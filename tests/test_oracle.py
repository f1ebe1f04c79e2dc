"""Every rate query against its DuckDB oracle on the smallest data set (text queries: tests/llm)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from pricelens.plans.oracle import ORACLE_SQL
from pricelens.plans.queries import SPARK_QUERIES

TABLES = ["supplier", "part", "lineitem", "region", "nation"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = SPARK_QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE_SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(df.columns, srows) == _rows(dcols, drows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["reporting_entity_name", "reporting_entity_type", "last_updated_on", "version"]
    assert df.count() > 0


def test_every_rate_query_has_an_oracle():
    assert set(SPARK_QUERIES) == set(ORACLE_SQL)
    assert set(SPARK_QUERIES) <= set(entry.queries())
