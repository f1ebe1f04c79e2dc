"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm import (
    chunk_recipes, compress_quality, html_template, language_ppm, periodic_runs, piece_tokenizer, poisson_mix, repeat_spans,
    simhash_tiles, spelling_variants, topk_segments, toxicity, warc_revisit,
)
from pricelens.llm.common import read_table


TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.exact_groups(read_table(spark, sf_dir, "documents"))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_revisit.resolve(warc_revisit.captures_of(read_table(spark, sf_dir, "pages")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return compress_quality.score(docs, compress_quality.fit(docs, read_table(spark, sf_dir, "labels")), threshold=0.3)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")), threshold=0.5)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return poisson_mix.mix(docs).select("doc_id", "copy", "source", "text", "mix_key")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tiles.near_groups(read_table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk_segments.quantised_rows(read_table(spark, sf_dir, "embeddings"))
    return topk_segments.top_k(rows.filter("vec_id % 100 = 0"), rows, k=10).select("query_id", "rank", "vec_id", "score")


def op10_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_spans.remove_repeats(read_table(spark, sf_dir, "documents"), length=100).drop("kept")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(read_table(spark, sf_dir, "pages"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str, model: str = TOKENIZER) -> DataFrame:
    data = piece_tokenizer.load_model(spark, model)
    return piece_tokenizer.encode(read_table(spark, sf_dir, "documents"), data, with_ids=False)


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_ppm.predict(docs, language_ppm.fit(docs))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(spelling_variants.word_counts(read_table(spark, sf_dir, "documents"), typos=True))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_echoes(read_table(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.periodic_runs(docs))


LLM_QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_quality": op3_quality,
    "op4_mix_sources": op4_mix_sources,
    "op5_simhash": op5_simhash,
    "op6_toxicity": op6_toxicity,
    "op7_topk": op7_topk,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_repeated_spans": op10_repeated_spans,
    "op11_language": op11_language,
    "op12_spelling": op12_spelling,
    "op13_periodic_runs": op13_periodic_runs,
}

OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM t
WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id ASC NULLS LAST)
"""

OP4_SQL = """
WITH s AS (
  SELECT source, sum(greatest(length(coalesce(text, '')), 1)) AS n_chars FROM documents GROUP BY source),
w AS (
  SELECT source, n_chars, pow(n_chars::DOUBLE, 0.5) AS weight FROM s),
r AS (
  SELECT source,
         round(weight / (SELECT sum(weight) FROM w) * (SELECT sum(n_chars) FROM w) / n_chars, 6) AS rate FROM w),
cdf AS (
  SELECT source, j, sum(term) OVER (PARTITION BY source ORDER BY j) AS cum
  FROM (SELECT source, j, exp(j * ln(rate) - rate - lgamma(j + 1.0)) AS term
        FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT + 1)) AS j FROM r WHERE rate > 0))),
d AS (
  SELECT doc_id, source, text, md5(coalesce(text, '')) AS t FROM documents),
n AS (
  SELECT d.*, ('0x' || substr(md5('42|count|' || coalesce(doc_id::VARCHAR, '') || '|' || t), 1, 13))::BIGINT::DOUBLE
              / 4503599627370496.0 AS u FROM d),
k AS (
  SELECT n.doc_id, n.source, n.text, n.t, count(cdf.j) AS copies
  FROM n JOIN cdf ON n.source IS NOT DISTINCT FROM cdf.source AND cdf.cum <= n.u
  GROUP BY ALL)
SELECT doc_id, unnest(range(1, copies + 1))::INTEGER AS copy, source, text,
       md5('42|order|' || coalesce(doc_id::VARCHAR, '') || '|' || t || '|' || unnest(range(1, copies + 1))::VARCHAR) AS mix_key
FROM k
"""

OP7_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum([p[1] * p[2] for p in list_zip(q.e, c.e)]), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM s)
SELECT * FROM r WHERE rank <= 10
"""

LLM_ORACLE_SQL = {
    "op2_warc_revisits": warc_revisit.REVISIT_SQL,
    "op4_mix_sources": OP4_SQL,
    "op7_topk": OP7_SQL,
    "op9_exact_dedup": OP9_SQL,
}
