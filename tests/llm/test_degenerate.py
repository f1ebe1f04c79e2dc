"""Empty tables, extra columns with clashing names, nulls, long texts and repeated rows, for operators and stages."""

import os
import random
from collections import Counter

import pytest

import corpus_pipeline
from conftest import SF_SMALL
from pricelens.llm import (
    chunk_recipes, compress_quality, html_template, poisson_mix, repeat_spans, simhash_tiles, topk_segments, toxicity, warc_revisit,
)
from pricelens.llm.common import written

CLASHING = ["__n", "__text_key", "__kept_id", "__kept_key", "__row_key", "__text", "__source", "__cdf", "__salt", "copy", "mix_key",
            "fp", "recipe", "score", "held_out", "COPY_"]


def with_clashes(df):
    for n, name in enumerate(CLASHING):
        df = df.withColumn(name, df["doc_id"] * 100 + n)
    return df


def documents(spark, rows):
    df = spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return written(with_clashes(df), "clashing")


ROWS = [(1, "a b c d e", "s"), (2, "a b  c d e", "s"), (2, "a b  c d e", "s"), (3, None, None), (4, "", "t"), (5, "w " * 20_000, "t"),
        (None, "x y z", "s"), (6, "quite another text, with words of its own.", "u")]


@pytest.mark.parametrize("rows", [ROWS, []], ids=["rows", "empty"])
def test_stages_keep_columns_and_values(spark, rows):
    docs = documents(spark, rows)
    before = {tuple(r) for r in docs.collect()}
    for stage in (corpus_pipeline.exact, corpus_pipeline.near, corpus_pipeline.mix):
        got = stage(spark, docs, SF_SMALL)
        assert got.columns == docs.columns
        assert {tuple(r) for r in got.collect()} <= before
    assert corpus_pipeline.encode(spark, docs, SF_SMALL).count() == len(rows)


def test_pipeline_with_empty_tables_and_with_clashing_columns(spark, tmp_dir):
    for name, rows in (("empty", []), ("rows", ROWS)):
        documents(spark, rows).write.parquet(os.path.join(tmp_dir, name, "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(os.path.join(tmp_dir, name, "labels.parquet"))
        got = corpus_pipeline.run(spark, os.path.join(tmp_dir, name)).collect()
        assert bool(got) == bool(rows)


def test_mixing_replaces_columns_of_its_own_names(spark):
    docs = documents(spark, ROWS)
    plain = poisson_mix.mix(docs.select("doc_id", "text", "source"))
    got = poisson_mix.mix(docs)
    assert Counter((r.doc_id, r["copy"], r.mix_key) for r in got.collect()) == Counter(
        (r.doc_id, r["copy"], r.mix_key) for r in plain.collect())
    assert [c for c in got.columns if c not in ("copy", "mix_key")] == [c for c in docs.columns if c not in ("copy", "mix_key")]
    many = poisson_mix.MAX_BROADCAST_SOURCES
    poisson_mix.MAX_BROADCAST_SOURCES = 0  # the salted join
    try:
        salted = poisson_mix.mix(docs).collect()
    finally:
        poisson_mix.MAX_BROADCAST_SOURCES = many
    assert Counter((r.doc_id, r.mix_key) for r in salted) == Counter((r.doc_id, r.mix_key) for r in plain.collect())


@pytest.mark.parametrize("module, label", [(compress_quality, "quality"), (toxicity, "toxic")])
def test_scores_of_odd_texts_under_a_fitted_model(spark, module, label):
    rnd = random.Random(6)
    words = {0: ["calm", "reed", "moss"], 1: ["vile", "scum", "rot"]}
    train = [(i, " ".join(rnd.choice(words[i % 2]) + f" w{rnd.randrange(500)}" for _ in range(40)), "s") for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], f"doc_id long, {label} int")
    docs = documents(spark, train)
    model = module.fit(docs, labels)
    assert "constant" not in model
    odd = [(400, None, None), (401, "", "s"), (402, " \n ", "s"), (403, "vile scum " * 20_000, "s"), (404, "calm", "s"), (404, "calm", "s"),
           (None, "vile scum rot", "s"), (405, "\u0000é😀" * 50, "s")]
    got = module.score(documents(spark, odd), model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _, _ in odd)
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(s) == 1 for s in by_id.values())  # repeated rows score alike
    assert by_id[400] == by_id[401]  # null counts as empty
    assert module.score(documents(spark, odd).limit(0), model).count() == 0


def test_operators_on_empty_tables_and_extra_columns(spark):
    docs = documents(spark, ROWS)
    for some in (docs, docs.limit(0)):
        n = some.count()
        assert chunk_recipes.exact_groups(some).count() == n
        assert simhash_tiles.near_groups(some).count() == n
        assert repeat_spans.remove_repeats(some).count() == n
    pages = spark.createDataFrame([(1, "http://a/b", "<p>x</p>", "t", 3), (1, "http://a/b", "<p>x</p>", "t", 3), (2, None, None, None, None)],
                                  "page_id long, url string, html string, text string, n_chars int")
    assert sorted((r.page_id, r.text, r.n_chars) for r in html_template.extract(pages).collect()) == [(1, "x", 1), (1, "x", 1), (2, "", 0)]
    assert html_template.extract(pages.limit(0)).count() == 0
    vectors = spark.createDataFrame([(100, [1.0, 2.0], 1, 2), (101, [0.5, 1.0], 1, 2), (101, [0.5, 1.0], 1, 2), (102, None, 1, 2)],
                                    "vec_id long, embedding array<double>, v int, g int")
    rows = topk_segments.quantised_rows(vectors)
    assert [(r.rank, r.vec_id) for r in topk_segments.top_k(rows.filter("vec_id % 100 = 0"), rows).orderBy("rank").collect()] == [(1, 101), (2, 101)]


def test_revisits_with_an_outlier_in_time_and_repeated_rows(spark):
    """One record at time 0 beside many of one week: slots are cut by counts, so no slot holds them all."""
    rows = [(n, "response", "http://a.b/x", 1_700_000_000 + n, {"ETag": f'"{n}"'}, f"d{n}", 7) for n in range(0, 4000, 2)]
    rows += [(n, "revisit", "http://a.b/x", 1_700_000_000 + n, {"ETag": f'"{n - 1}"'}, None, 7) for n in range(1, 4000, 2)]
    rows += [(-1, "response", "http://a.b/x", 0, {}, None, 7), (-2, "revisit", "http://a.b/x", 5, None, None, 7)]
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, ts long, headers map<string,string>, digest string, slot int")
    slots = warc_revisit._slotted(df.select("record_id", "ts"), 64).groupBy("slot").count().collect()
    assert max(r["count"] for r in slots) < 200 and len(slots) > 40
    for parts in (3, 64, 1000):
        got = {r.record_id: (r.response_id, r.status) for r in warc_revisit.resolve(df, slots=parts).collect()}
        assert got == {n: (n - 1, "resolved") for n in range(1, 4000, 2)} | {-2: (-1, "no_validator")}
    twice = warc_revisit.resolve(df.unionByName(df.filter("record_id = 1")))
    assert twice.filter("record_id = 1").count() == 2
