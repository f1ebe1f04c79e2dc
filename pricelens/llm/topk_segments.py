"""Exact top-k inner products, pruned by segment statistics from coarse to fine.

A vector is cut into segments; of each segment the mean and the deviation are kept. With
them an inner product has the upper bound

    q . x <= sum over segments of m * (mean_q * mean_x + dev_q * dev_x)

(Cauchy-Schwarz on the parts orthogonal to the segment's constant vector), which is the
lower bound on the distance written for scores, as |q - x|^2 = |q|^2 + |x|^2 - 2 q.x.
Bounds tighten as segments shrink. They are used from coarse to fine:

1. A query's threshold is the k-th best of its exact scores with at most ``PROBES`` rows, spread
   evenly over the rows' order by their coarse means.
2. Rows are dealt in that order into groups of ``GROUP_ROWS``, of which the least and largest means
   and the largest deviations are kept. A group whose bound stays below the threshold is
   never sent to the query.
3. Inside a group the bounds of ``LEVELS`` are taken level by level, each for the candidates that the
   level before has left, and only survivors are scored exactly, in integers.

Scale: queries (a stated set of rows) meet all rows in blocks. Rows are numbered inside range
partitions, so equal rows are dealt evenly, too. Every (group, block of ``QUERY_ROWS`` queries) cell
with a query that needs the group is one task-sized unit and returns at most k rows for each of its
queries; a task holds one group of rows and one block of queries, whatever the table's size.
Groups' bounds are compared with blocks of queries in the same way, ``GROUP_ROWS`` groups at a
time. Only the probes are broadcast (``PROBES`` rows). The best k of the cells are merged by a
window with a partial limit. How much is pruned depends on the data: rows without any structure have
thresholds that only the finest level can use.

Defined cases: vectors that are null or hold null or non-finite components take no part,
neither as query nor as candidate; shorter vectors count as padded with zeros; an empty
vector scores 0 with everything; rows sharing the query's vec_id are its own and no
candidates; repeated query ids ask with each of their vectors, and the k best scores of all of them
count; a null vec_id takes no part. Repeated candidate rows appear as often as they occur.
Components beyond 2**62 and scores beyond 64 bits are clipped to those limits. Extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pricelens.llm.common import written

GROUP_ROWS, QUERY_ROWS = 8192, 1024
PROBES = 4096
LEVELS = (4, 16, 32)  # segments, from coarse to fine
SCALE = 1024
EXACT = float(1 << 53)
LIMIT = 1 << 62


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as longs clipped to +-2**62."""
    return F.transform(vector, lambda x: F.floor(
        F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), F.lit(float(scale)) * x.cast("double")))).cast("long"))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def segment_stats(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of each row, both times the root of the segment's width."""
    edges = np.linspace(0, x.shape[1], min(segments, max(x.shape[1], 1)) + 1).astype(int)
    mean = np.empty((len(x), len(edges) - 1))
    dev = np.empty_like(mean)
    for s, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        part = x[:, a:b]
        m = part.mean(axis=1) if b > a else np.zeros(len(x))
        mean[:, s] = m * np.sqrt(b - a)
        dev[:, s] = np.sqrt(((part - m[:, None]) ** 2).sum(axis=1))
    return mean, dev


def slack(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """What rounding may add to a bound: more than any floating-point error."""
    return 1e-9 * np.sqrt((q ** 2).sum(axis=1))[:, None] * np.sqrt((x ** 2).sum(axis=1))[None, :] + 1.0


def exact_scores(q: np.ndarray, x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Integer inner products of one query with the rows ``at``."""
    rows = x[at]
    top = float(np.abs(q).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(x.shape[1], 1)
    if top < EXACT:
        return (rows.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    lo, hi = -(1 << 63), (1 << 63) - 1
    big = rows.astype(object) @ q.astype(object)
    return np.array([min(max(int(v), lo), hi) for v in big], dtype=np.int64)


def best_of_cell(qids, floors, q, xids, x, k: int):
    """((query_id, vec_id, score) of each query's k best rows of a cell that reach its floor, rows scored for
    each query); ties go to the smaller vec_id."""
    qf, xf = q.astype(np.float64), x.astype(np.float64)
    levels = [(segment_stats(qf, n), segment_stats(xf, n)) for n in LEVELS if n == LEVELS[0] or n < x.shape[1]]
    room = slack(qf, xf)
    small = float(np.abs(qf).max(initial=0)) * float(np.abs(xf).max(initial=0)) * max(x.shape[1], 1) < EXACT
    (mq, dq), (mx, dx) = levels[0]
    coarse = mq @ mx.T + dq @ dx.T + room >= floors[:, None]
    found, scored = [], []
    for n, qid in enumerate(qids.tolist()):
        live = np.flatnonzero(coarse[n] & (xids != qid))
        for (mq, dq), (mx, dx) in levels[1:]:
            live = live[mx[live] @ mq[n] + dx[live] @ dq[n] + room[n, live] >= floors[n]]
        score = (xf[live] @ qf[n]).astype(np.int64) if small else exact_scores(q[n], x, live)
        scored.append(len(live))
        order = np.lexsort((xids[live], ~score))[:k]  # ~s orders longs downwards without overflow
        found.append((np.full(len(order), qid), xids[live][order], score[order]))
    return found, scored


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy()
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, col] = flat
    return out


def _vectors(table: pa.Table, width: int = 0) -> np.ndarray:
    """The column v as a matrix of the widest vector's width, ``width`` at least."""
    lists = table.column("v").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    return _matrix(lists, int(np.diff(lists.offsets.to_numpy()).max(initial=width)))


def _cell(table: pa.Table, k: int) -> pa.Table:
    asks = table.column("asks").to_numpy()
    all_, ids, floors = _vectors(table), table.column("vec_id").to_numpy(), table.column("floor").to_numpy()
    found, scored = best_of_cell(ids[asks], floors[asks], all_[asks], ids[~asks], all_[~asks], k)
    cols = [np.concatenate([np.asarray(c, np.int64) for c in cs] or [np.empty(0, np.int64)]) for cs in (list(zip(*found)) or [[]] * 3)]
    n, asked = len(cols[0]), ids[asks]
    best = [pa.array(c) for c in cols] + [pa.nulls(n, pa.int64())]
    counts = [pa.array(asked), pa.nulls(len(asked), pa.int64()), pa.nulls(len(asked), pa.int64()), pa.array(np.asarray(scored, np.int64))]
    return pa.table([pa.concat_arrays(c) for c in zip(best, counts)], names=["query_id", "vec_id", "score", "scored"])


def _ordered(rows: DataFrame, group_rows: int) -> DataFrame:
    """(vec_id, v, g): rows in groups of neighbours by their coarse means; written once."""
    size = F.greatest(F.ceil(F.size("v") / F.lit(LEVELS[0])).cast("int"), F.lit(1))
    means = [F.aggregate(F.slice("v", size * i + 1, size), F.lit(0.0), lambda a, x: a + x.cast("double")) for i in range(LEVELS[0])]
    keyed = rows.select("vec_id", "v", *[m.alias(f"m{i}") for i, m in enumerate(means)],
                        F.monotonically_increasing_id().alias("tie"))
    keys = [f"m{i}" for i in range(LEVELS[0])] + ["tie"]
    number = F.monotonically_increasing_id()  # partition number in the upper bits, row number in the lower 33
    dealt = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("vec_id", "v", number.alias("number"))
    return written(dealt.select("vec_id", "v", "number", F.expr(
        f"shiftright(number, 33) * {1 << 20} + (number & {(1 << 33) - 1}) div {group_rows}").alias("g")), "topk-rows")


def group_bounds(rows: DataFrame, width: int) -> DataFrame:
    """(g, low, high, dev): of each group and coarse segment the least and largest mean and the largest deviation."""
    n = LEVELS[0]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                mean, dev = segment_stats(_vectors(pa.Table.from_batches([batch]), width).astype(np.float64), n)
                mean, dev = (np.pad(x, ((0, 0), (0, n - x.shape[1]))) for x in (mean, dev))
                yield pa.RecordBatch.from_arrays([batch.column("g"), *map(pa.array, mean.T), *map(pa.array, dev.T)],
                                                 names=["g", *[f"m{i}" for i in range(n)], *[f"d{i}" for i in range(n)]])

    stats = rows.select("g", "v").mapInArrow(run, "g long, " + ", ".join(f"{c}{i} double" for c in "md" for i in range(n)))
    return stats.groupBy("g").agg(*[F.min(f"m{i}").alias(f"low{i}") for i in range(n)],
                                  *[F.max(f"m{i}").alias(f"high{i}") for i in range(n)],
                                  *[F.max(f"d{i}").alias(f"dev{i}") for i in range(n)])


def _floors(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """``queries`` with ``floor``: the k-th best exact score with the probes; the least long without k of them."""
    total = rows.count()
    step = max(total // PROBES, 1)
    probes = rows.filter(F.col("number").bitwiseAND(F.lit((1 << 33) - 1)) % step == 0).select("vec_id", "v").limit(2 * PROBES).toArrow()
    sent = queries.sparkSession.sparkContext.broadcast(probes)
    lowest = -(1 << 63)

    def run(batches):
        table = sent.value
        xids, x = table.column("vec_id").to_numpy(), _vectors(table)
        for batch in batches:
            floors, ids = [], batch.column("vec_id").to_numpy()
            lists = batch.column("v")
            for n, qid in enumerate(ids.tolist()):
                q = lists[n].values.to_numpy()
                width = max(len(q), x.shape[1])
                at = np.flatnonzero(xids != qid)
                if len(at) < k:
                    floors.append(lowest)
                    continue
                score = exact_scores(np.pad(q, (0, width - len(q))), np.pad(x, ((0, 0), (0, width - x.shape[1]))), at)
                floors.append(int(np.partition(score, len(score) - k)[len(score) - k]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors, pa.int64())], names=[*batch.schema.names, "floor"])

    return queries.mapInArrow(run, "query long, vec_id long, v array<bigint>, b long, floor long")


def _needed(queries: DataFrame, bounds: DataFrame, blocks: int, width: int) -> DataFrame:
    """(query, g): the groups whose bound reaches the query's floor."""
    n = LEVELS[0]
    tiles = max(-(-bounds.count() // GROUP_ROWS), 1)
    stats = [f"{c}{i}" for c in ("low", "high", "dev") for i in range(n)]
    right = bounds.select(F.lit(None).cast("long").alias("query"), F.lit(None).cast("array<bigint>").alias("v"), F.lit(None).cast("long").alias("floor"),
                          "g", *stats, F.pmod(F.xxhash64("g"), F.lit(tiles)).alias("t"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("b"))
    left = queries.select("query", "v", "floor", F.lit(None).cast("long").alias("g"), *[F.lit(None).cast("double").alias(c) for c in stats],
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))).alias("t"), "b")

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("query").is_valid()
        ask, group = table.filter(asks), table.filter(pc.invert(asks))
        if not ask.num_rows or not group.num_rows:
            return pa.table([pa.array([], pa.int64())] * 2, names=["query", "g"])
        q = _vectors(ask, width).astype(np.float64)
        mq, dq = (np.pad(x, ((0, 0), (0, n - x.shape[1]))) for x in segment_stats(q, n))
        low, high, dev = (np.stack([group.column(f"{c}{i}").to_numpy() for i in range(n)], axis=1) for c in ("low", "high", "dev"))
        bound = np.maximum(mq, 0) @ high.T + np.minimum(mq, 0) @ low.T + dq @ dev.T
        size = np.sqrt(np.maximum(low ** 2, high ** 2).sum(axis=1) + (dev ** 2).sum(axis=1))
        bound += 1e-9 * np.sqrt((q ** 2).sum(axis=1))[:, None] * size[None, :] + 1.0
        i, j = np.nonzero(bound >= ask.column("floor").to_numpy().astype(np.float64)[:, None])
        return pa.table([ask.column("query").combine_chunks().take(pa.array(i)), group.column("g").combine_chunks().take(pa.array(j))],
                        names=["query", "g"])

    return right.unionByName(left).groupBy("t", "b").applyInArrow(run, "query long, g long")


def top_k(queries: DataFrame, rows: DataFrame, k: int = 10, group_rows: int = GROUP_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best rows, n_scored (rows scored exactly for it) and n_rows
    (all rows); both sides are (vec_id long, v array<long>)."""
    dealt = _ordered(rows, group_rows)
    n_rows, n_queries = dealt.count(), queries.count()
    blocks = -(-n_queries // query_rows) or 1
    asking = queries.select(F.monotonically_increasing_id().alias("query"), "vec_id", "v")
    asking = asking.withColumn("b", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    asking = written(_floors(written(asking, "topk-queries"), dealt, k), "topk-floors")
    width = dealt.select("v").unionByName(asking.select("v")).agg(F.max(F.size("v"))).first()[0] or 0
    needed = written(_needed(asking, group_bounds(dealt, width), blocks, width), "topk-groups")
    left = needed.join(asking, "query").select("vec_id", "v", F.lit(True).alias("asks"), "floor", "g", "b")
    cells = needed.join(asking.select("query", "b"), "query").select("g", "b").distinct()
    right = dealt.join(cells, "g").select("vec_id", "v", F.lit(False).alias("asks"), F.lit(0).cast("long").alias("floor"), "g", "b")
    out = written(right.unionByName(left).groupBy("g", "b").applyInArrow(
        lambda t: _cell(t, k), "query_id long, vec_id long, score long, scored long"), "topk-cells")
    counts = out.groupBy("query_id").agg(F.coalesce(F.sum("scored"), F.lit(0)).alias("n_scored"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    best = out.filter(F.col("vec_id").isNotNull()).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(counts, "query_id").select("query_id", "rank", "vec_id", "score", "n_scored", F.lit(n_rows).cast("long").alias("n_rows"))


def quantised_rows(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): the rows that take part, quantised."""
    return embeddings.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("v"))
