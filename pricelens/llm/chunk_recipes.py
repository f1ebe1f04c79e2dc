"""Exact dedup by content-defined chunk recipes, in DataFrame operations only.

A text, with its white space deleted, is cut into chunks after punctuation (so the cut
positions follow the content), each chunk becomes a 64-bit identifier, and a document
becomes the ordered list of its identifiers, its *recipe*. Chunks are deduplicated to
verified identifiers: two chunks that share a 64-bit hash but differ in SHA-256 get
different ordinals. Documents are then grouped by their recipes, so the texts themselves
never cross a shuffle; a recipe has 8 bytes for about 500 characters.

Scale: one narrow pass over the texts writes (row, length, digest, recipe) to the shared
checkpoint folder. Groups are pre-aggregated before their shuffle, and every row meets its
group's result in an equi-join that adaptive execution splits for a hot recipe.

Defined cases: a null text counts as empty; empty texts are equal to each other; among
equal texts with equal length and equal doc_id (repeated rows) exactly one row stays, any
of them, as they do not differ; a null doc_id sorts after all others. Extra columns are
ignored by ``exact_groups`` and kept by ``drop_exact_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pricelens.llm.common import free_name, written

WHITE_SPACE = r"[\x20\x09-\x0D]+"
# A chunk ends after the first punctuation mark past MIN characters, or at MAX characters.
CHUNK_MIN, CHUNK_MAX = 256, 2048
CHUNK = r"(?s).{%d,%d}?[.,;:!?|]|.{1,%d}" % (CHUNK_MIN - 1, CHUNK_MAX - 1, CHUNK_MAX)


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def chunks(norm: Column) -> Column:
    """The content-defined chunks of a normalised text, in order; they concatenate to it."""
    return F.regexp_extract_all(norm, F.lit(CHUNK), F.lit(0))


def draft_recipes(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, n_chars, text_sha256, hashes, digests), one row per document; written once."""
    base = docs.select(
        F.col("doc_id"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        normalised(F.col("text")).alias("norm"),
    ).withColumn("chunks", chunks(F.col("norm")))
    return written(base.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "n_chars",
        F.sha2("norm", 256).alias("text_sha256"),
        F.transform("chunks", lambda c: F.xxhash64(c)).alias("hashes"),
        F.transform("chunks", lambda c: F.unhex(F.sha2(c, 256))).alias("digests"),
    ), "recipes")


def colliding_identifiers(drafts: DataFrame) -> DataFrame:
    """(hash, digest, ordinal) of chunks whose 64-bit hash is shared by another chunk: none, as a rule."""
    pairs = drafts.select(F.explode(F.arrays_zip("hashes", "digests")).alias("c")).select(
        F.col("c.hashes").alias("hash"), F.col("c.digests").alias("digest"))
    digests = pairs.groupBy("hash").agg(F.sort_array(F.collect_set("digest")).alias("d"))  # one digest, as a rule
    return digests.filter(F.size("d") > 1).select("hash", F.posexplode("d").alias("ordinal", "digest"))


def verified_recipes(drafts: DataFrame) -> DataFrame:
    """Drafts with ``recipe``: the ordered verified identifiers of the document's chunks."""
    clashes = written(colliding_identifiers(drafts), "recipe-collisions")
    if clashes.isEmpty():  # one bounded probe; every 64-bit hash is then verified as it stands
        return drafts.select("row_id", "doc_id", "n_chars", "text_sha256", F.col("hashes").alias("recipe"))
    parts = drafts.select("row_id", F.posexplode(F.arrays_zip("hashes", "digests")).alias("pos", "c")).select(
        "row_id", "pos", F.col("c.hashes").alias("hash"), F.col("c.digests").alias("digest"))
    mended = (
        parts.join(clashes, ["hash", "digest"], "left")
        .groupBy("row_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "hash", "ordinal"))).alias("p"))
        .select("row_id", F.transform(
            "p", lambda x: F.when(x["ordinal"].isNull(), x["hash"]).otherwise(F.xxhash64(x["hash"], x["ordinal"]))
        ).alias("mended"))
    )
    return drafts.join(mended, "row_id", "left").select(
        "row_id", "doc_id", "n_chars", "text_sha256", F.coalesce("mended", "hashes").alias("recipe"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in the original text, then the
    smallest doc_id, stays.
    """
    recipes = verified_recipes(draft_recipes(docs))
    groups = recipes.groupBy("recipe").agg(
        F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"))
        .alias("best"),
        F.count(F.lit(1)).alias("group_size"),
    )
    return recipes.join(groups, "recipe").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops, all columns as they are.

    The kept rows are recognised by (doc_id, digest of the original text); of repeated
    rows that agree in both, one stays.
    """
    names = docs.columns
    key, n, kept_id, kept_key = (free_name(docs, x) for x in ("__text_key", "__n", "__kept_id", "__kept_key"))
    keyed = docs.withColumn(key, F.sha2(normalised(F.col("text")), 256))
    kept = exact_groups(docs).filter("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_key))
    hits = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(key) == F.col(kept_key)), "left_semi")
    # Repeated rows: rows of one doc_id with equal texts, longest original first.
    one = Window.partitionBy("doc_id", key).orderBy(F.length("text").desc(), F.col("text"))
    return hits.withColumn(n, F.row_number().over(one)).filter(F.col(n) == 1).select(*names)
