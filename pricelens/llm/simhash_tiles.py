"""SimHash near-dedup by tiled exact comparison.

Every document gets a 64-bit fingerprint from its word shingles. All pairs of fingerprints
within ``radius`` bits are found exactly: fingerprints are gathered in tiles, tiles are
compared with numpy's exclusive-or and bit counts, and tile pairs whose population counts
differ by more than the radius are skipped, as no pair in them can be that close.

What lets the tiles scale: cut the 64 bits into ``radius + 1`` blocks. Two fingerprints
that differ in at most ``radius`` bits agree in one block at least, so only fingerprints
sharing a block value need to meet. Each distinct fingerprint goes to ``radius + 1`` block
groups. A group beyond ``tile_rows`` is split by population count and salt into cells, and
every pair of cells within the radius is a task key of its own, so no task ever holds more
than two cells. Within a key, links are reduced to a spanning forest before they leave the
task: a group of n near copies yields n - 1 edges, never n squared pairs.

Classes are the connected components of those edges, found by alternating large-star and
small-star rounds, each written to the shared checkpoint folder.

Defined cases: a null text counts as empty; texts without words have fingerprint zero and
link like any other; fewer words than the shingle length give one shingle of all words;
repeated rows share a fingerprint and each get their row; a null doc_id never becomes a
component id unless all of its component's doc_ids are null. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import free_name, map_batches, written

SEED = 42
SHINGLES_AT_ONCE = 65_536  # bounds the bit matrix of a very long text (4 MB)
TILE_ROWS = 4096
BLOCK = 1024  # rows and columns of one exclusive-or matrix


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a UTF-8 text (unsigned)."""
    words = text.lower().split()  # bytes: A-Z only, and splits at 0x20, 0x09-0x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = min(shingle, len(words))
    first, last = starts[: len(words) - n + 1].tolist(), ends[n - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), SHINGLES_AT_ONCE):
        part = zip(first[at: at + SHINGLES_AT_ONCE], last[at: at + SHINGLES_AT_ONCE], strict=True)
        h = np.array([digest(joined[s:e], SEED) for s, e in part], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, carried binary columns): one row per document; ``fp`` is the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch):
        texts = batch.column(1)
        fps = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64)), *batch.columns[2:]],
            names=["doc_id", "fp", *carried])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *carried)
    return map_batches(source, run, ", ".join(["doc_id long, fp long", *(f"`{c}` binary" for c in carried)]))


# ---- links inside a key ------------------------------------------------------------------


class Forest:
    """Spanning forest over row numbers, grown from arrays of links."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.edges: list[np.ndarray] = []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.label[i], self.label[j]
            open_ = a != b
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            if not len(i):
                return
            hi, lo = np.maximum(a, b), np.minimum(a, b)
            parent = np.arange(len(self.label))
            np.minimum.at(parent, hi, lo)
            moved = np.unique(hi)
            self.edges.append(np.stack([moved, parent[moved]], axis=1))
            while not np.array_equal(parent, up := parent[parent]):
                parent = up
            self.label = parent[self.label]


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int):
    """Row numbers (in a, in b) of fingerprints within the radius; both sorted by population count."""
    pa_, pb = np.bitwise_count(a), np.bitwise_count(b)
    for i in range(0, len(a), BLOCK):
        x, px = a[i: i + BLOCK], pa_[i: i + BLOCK].astype(int)
        for j in range(0, len(b), BLOCK):
            y, py = b[j: j + BLOCK], pb[j: j + BLOCK].astype(int)
            if px[0] - py[-1] > radius or py[0] - px[-1] > radius:
                continue
            near = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
            u, v = np.nonzero(near)
            yield u + i, v + j


def forest_of_group(fps: np.ndarray, side: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that connect what links inside one key; rows of side 1 only meet those of side 0."""
    order = np.lexsort((np.bitwise_count(fps), side))
    fps, side = fps[order], side[order]
    cut = int(np.searchsorted(side, 1))
    forest = Forest(len(fps))
    if cut < len(fps):
        for u, v in close_pairs(fps[:cut], fps[cut:], radius):
            forest.add(u, v + cut)
    else:
        for u, v in close_pairs(fps, fps, radius):
            keep = u < v
            forest.add(u[keep], v[keep])
    return [(int(fps[p]), int(fps[q])) for e in forest.edges for p, q in e.tolist()]


SMALL = 48  # groups up to this size are compared together, lag by lag


def _edges(keys: np.ndarray, sides: np.ndarray, fps: np.ndarray, radius: int) -> pa.RecordBatch:
    """Edges of complete keys; rows are sorted by key."""
    src, dst = [], []
    change = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[change, len(keys)])
    small = np.repeat(size <= SMALL, size)
    k, f = keys[small], fps[small]
    for lag in range(1, min(SMALL, len(k))):
        same = k[lag:] == k[:-lag]
        if not same.any():
            break
        hit = same & (np.bitwise_count(f[lag:] ^ f[:-lag]) <= radius)
        src.append(f[lag:][hit])
        dst.append(f[:-lag][hit])
    for at, n in zip(change[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
        pairs = np.array(forest_of_group(fps[at: at + n], sides[at: at + n], radius), dtype=np.uint64).reshape(-1, 2)
        src.append(pairs[:, 0])
        dst.append(pairs[:, 1])
    a = np.concatenate(src) if src else np.empty(0, np.uint64)
    b = np.concatenate(dst) if dst else np.empty(0, np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["u", "v"])


def links(distinct: DataFrame, radius: int = 3, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(u, v): edges whose components are those of all pairs of ``distinct.fp`` within the radius."""
    blocks = radius + 1
    width = -(-64 // blocks)
    parts = [
        F.struct(F.lit(b).alias("b"), F.shiftrightunsigned("fp", b * width).bitwiseAND(F.lit((1 << width) - 1)).alias("v"))
        for b in range(blocks) if b * width < 64
    ] if radius else [F.struct(F.lit(0).alias("b"), F.col("fp").alias("v"))]
    rows = distinct.select("fp", F.bit_count("fp").alias("pc"), F.explode(F.array(*parts)).alias("k")).select(
        "fp", "pc", "k.b", "k.v")
    # Block groups too large for one tile: their number of salted cells by population count.
    hot = (
        rows.groupBy("b", "v", "pc").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("b", "v").agg(
            F.sum("n").alias("n"),
            F.map_from_entries(F.collect_list(F.struct(
                "pc", F.ceil(F.col("n") / F.lit(tile_rows)).cast("int")))).alias("cells"))
        .filter(F.col("n") > tile_rows).select("b", "v", "cells")
    )
    # A row's cell is (pc, salt); it meets each cell of its group within the radius.
    salt = F.pmod(F.xxhash64("fp"), F.col("cells")[F.col("pc")]).cast("int")
    me = F.struct(F.col("pc").alias("pc"), F.col("salt").alias("s"))

    def with_cell(pc, s):
        other = F.struct(pc.alias("pc"), s.alias("s"))
        return F.struct(F.least(me, other).alias("a"), F.greatest(me, other).alias("z"), (me > other).cast("int").alias("side"))

    partners = F.flatten(F.transform(
        F.sequence(F.col("pc") - radius, F.col("pc") + radius),
        lambda p: F.transform(
            F.when(F.col("cells")[p].isNull(), F.array().cast("array<int>"))
            .otherwise(F.sequence(F.lit(0), F.col("cells")[p] - 1)),
            lambda s: with_cell(p, s))))
    none = F.struct(F.lit(-1).alias("pc"), F.lit(-1).alias("s"))
    alone = F.array(F.struct(none.alias("a"), none.alias("z"), F.lit(0).alias("side")))
    keyed = (
        rows.join(hot, ["b", "v"], "left")
        .withColumn("salt", F.when(F.col("cells").isNotNull(), salt))
        .select("b", "v", "fp", F.explode(F.when(F.col("cells").isNull(), alone).otherwise(partners)).alias("c"))
        .select(F.xxhash64("b", "v", "c.a.pc", "c.a.s", "c.z.pc", "c.z.s").alias("key"),
                F.col("c.side").alias("side"), "fp")
    )

    def run(batches):
        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            key = cols[0]
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1], side="left"))  # the last key may go on in the next batch
            if cut:
                yield _edges(key[:cut], cols[1][:cut], cols[2][:cut].view(np.uint64), radius)
            held = [c[cut:] for c in cols]
        if held is not None and len(held[0]):
            yield _edges(held[0], held[1], np.ascontiguousarray(held[2]).view(np.uint64), radius)

    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(run, "u long, v long")


# ---- components --------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (u, v) with the smallest node of its component.

    Alternates large-star and small-star until the edges no longer change; the number of
    rounds grows with the logarithm of the nodes. Nothing but two counts reaches the driver.
    """

    def canonical(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def stars(df: DataFrame, large: bool) -> DataFrame:
        both = df.unionByName(df.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else df
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = both.join(low, "u")
        if large:
            return canonical(joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        return canonical(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))))

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()

    now = written(canonical(edges), "components")
    seen = state(now)
    while seen[0]:
        now = written(stars(stars(now, True), False), "components")
        if (new := state(now)) == seen:
            break
        seen = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_groups(docs: DataFrame, shingle: int = 3, radius: int = 3, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    prints = written(fingerprints(docs, shingle), "simhash")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(links(distinct.select("fp"), radius, tile_rows))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.join(ids, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest doc_id, a null one last.

    Rows are told apart by a key, the digest of doc_id and text, as a doc_id may be null or
    shared; of a group's rows with the smallest doc_id the smallest key counts. Of rows that
    agree in both doc_id and text any one stays.
    """
    names = docs.columns
    key, kept_key = free_name(docs, "__row_key"), free_name(docs, "__kept_key")
    digest = F.sha2(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))), 256)
    keyed = docs.withColumn(key, F.unhex(digest))
    prints = written(fingerprints(keyed, shingle, (key,)), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col(key).alias("key"))
    distinct = prints.groupBy("fp").agg(F.min(order).alias("best"))
    roots = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "best", F.coalesce("root", "fp").alias("root"))
    kept = rooted.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.key").alias(kept_key))
    return keyed.dropDuplicates([key]).join(kept, F.col(key) == F.col(kept_key), "left_semi").select(*names)
