"""A part sold far more often than the rest: the fixture splits its item into
bounded chunks, and the flatten still matches the SQL oracle."""

import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as entry
from conftest import SF_SMALL
from pricelens.sources.fixtures import ORDER_SPAN, fixture_in_network


def _skewed_dir(tmp_dir):
    for t in ("supplier", "part", "region", "nation"):
        pq.write_table(pq.read_table(f"{SF_SMALL}/{t}.parquet"), f"{tmp_dir}/{t}.parquet")
    li = pq.read_table(f"{SF_SMALL}/lineitem.parquet")
    n = 8192
    base = li.slice(0, 1).to_pylist()[0]
    extra = []
    for k in range(n):
        row = dict(base)
        row.update(l_orderkey=10_000 + k // 3 * (ORDER_SPAN // 512), l_linenumber=k % 3 + 1, l_partkey=7,
                   l_suppkey=k % 10, l_extendedprice=100.0 + k)
        extra.append(row)
    hot = pa.Table.from_pylist(extra, schema=li.schema)
    pq.write_table(pa.concat_tables([li, hot]), f"{tmp_dir}/lineitem.parquet")
    return tmp_dir


def test_hot_part_is_split_and_matches_oracle(spark, tmp_dir):
    d = _skewed_dir(tmp_dir)
    items = fixture_in_network(spark, d, keep_keys=True)
    hot_items = items.where("p_partkey = 7").count()
    assert hot_items > 1
    biggest = items.selectExpr("aggregate(transform(negotiated_rates, r -> size(r.negotiated_prices)), 0, "
                               "(a, b) -> a + b) AS n").agg({"n": "max"}).first()[0]
    assert biggest < 4096
    con = duckdb.connect()
    for t in ("supplier", "part", "lineitem", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(d, t)}.parquet')")
    for name in ("flatten_rates", "explode_rates", "stage_counts"):
        df = entry.queries()[name](spark, d)
        res = con.execute(entry.oracle_sql()[name])
        srows = sorted(map(lambda r: tuple(map(str, r)), df.select(sorted(df.columns)).collect()))
        cols = [c[0] for c in res.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        drows = sorted(tuple(str(r[i]) for i in order) for r in res.fetchall())
        assert srows == drows, name
