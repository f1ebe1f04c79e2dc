"""Exact top-k against brute force, and what the bounds prune."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import topk_segments as topk


def brute(rows, asks, k):
    out = []
    for qid in sorted({i for i, _ in asks}):
        scores = [(sum(a * b for a, b in zip(q, v)), i) for j, q in asks if j == qid for i, v in rows if i != qid]
        found = sorted((-min(max(s, -(1 << 63)), (1 << 63) - 1), i) for s, i in scores)  # clipped to 64 bits
        out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return out


def run(spark, rows, k=5, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = topk.top_k(df.filter("vec_id % 10 = 0"), df, k, **sizes)
    asks = [r for r in rows if r[0] % 10 == 0]
    assert [tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").orderBy("query_id", "rank").collect()] == brute(rows, asks, k)
    return got


@pytest.mark.parametrize("width", [1, 3, 8, 40, 64])
def test_matches_brute_force(spark, width):
    rng = np.random.default_rng(width)
    rows = [(int(i), [int(x) for x in rng.integers(-1000, 1000, width)]) for i in rng.integers(0, 150, 300)]  # ids repeat, also asking ones
    rows += [(1000, []), (1001, [5]), (1002, [0] * width)] + [(7, rows[0][1])] * 60
    run(spark, rows, group_rows=32, query_rows=4)


def test_clustered_rows_are_pruned_by_groups_and_levels(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 64)).cumsum(axis=1)
    rows = [(i, [int(x) for x in np.floor(1024 * (centres[i % 20] + 0.05 * rng.normal(size=64)))]) for i in range(2000)]
    got = run(spark, rows, group_rows=50, query_rows=64)
    share = got.select((1 - F.col("n_scored") / F.col("n_rows")).alias("s")).agg(F.avg("s")).first()[0]
    assert share > 0.8


def test_equal_rows_are_dealt_evenly(spark):
    df = spark.createDataFrame([(i, [3, 1, 4, 1]) for i in range(3000)], "vec_id long, v array<long>")
    sizes = [r["count"] for r in topk._ordered(df, 100).groupBy("g").count().collect()]
    assert max(sizes) <= 100 and len(sizes) >= 30


def test_empty_and_large_values(spark):
    empty = spark.createDataFrame([], "vec_id long, v array<long>")
    assert topk.top_k(empty, empty).count() == 0
    big = 1 << 40
    rows = [(10, [big, -big, 3]), (11, [big, 1, 1]), (12, [-big, 5, 5]), (13, [1, 1, 1]), (20, [0, 0, 0])]
    run(spark, rows, k=3)
