"""The SQL of the mixing operator at large rates."""

import duckdb

from pricelens.llm import poisson_mix
from pricelens.llm.queries import OP4_SQL


def test_mixing_sql_reaches_large_rates(spark):
    rows = [(1, "x", "small"), (2, "y" * 200_000, "large")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    want = con.execute(f"SELECT doc_id, copy FROM ({OP4_SQL})").fetchall()
    assert sorted((r.doc_id, r["copy"]) for r in poisson_mix.mix(docs).collect()) == sorted(want) and len(want) > 300
