"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's
result to the shared checkpoint folder and gives it to the next. All stages but the last
return the columns of ``documents``.

1. quality: documents scored below 0.3 by the compression classifier go.
2. exact: of equal texts one document stays.
3. near: of each group of SimHash near-duplicates one document stays.
4. mix: documents are repeated so that sources meet their target weights, in global random order.
5. encode: SentencePiece ids of each document.

Null and empty texts, nulls in other columns, repeated rows and empty tables are handled as
the operators' docstrings say; columns beyond those of ``documents`` are carried to stage 4, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelens.llm import chunk_recipes, compress_quality, piece_tokenizer, poisson_mix, simhash_tiles
from pricelens.llm.common import free_name, read_table, written

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = compress_quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return compress_quality.keep_good(docs, model, threshold=0.3)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunk_recipes.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_tiles.keep_one_of_each(docs, shingle=3, radius=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copy, key = free_name(docs, "copy"), free_name(docs, "mix_key")
    return poisson_mix.mix(docs, temperature=0.5, copy=copy, key=key).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str, model: str = TOKENIZER) -> DataFrame:
    data = piece_tokenizer.load_model(spark, model)
    return piece_tokenizer.encode(docs, data, extra=("doc_id", "lang", "source"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("encode", encode)]

ORACLE_SQL = None  # zstandard sizes, SimHash components and SentencePiece ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
