"""The corpus pipeline against brute force, with null and shared doc_ids."""

import hashlib
import math
import os
import re
from collections import Counter

import duckdb
import sentencepiece

import corpus_pipeline
from conftest import SF_SMALL
from llm.test_operators import brute_print
from pricelens.llm import simhash_tiles

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def raw():
    base = [t for t, in duckdb.sql(f"SELECT text FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id LIMIT 12").fetchall()]
    rows = [(i, t) for i, t in enumerate(base[:6])]
    rows += [(2, base[7]), (2, base[8] + " and more"), (2, base[2] + " tail")]  # dissimilar and similar texts sharing an id
    rows += [(None, f"{base[3]} tail{i}") for i in range(4)]  # near copies of a named document
    rows += [(None, f"{base[9]} tail{i}") for i in range(5)]  # a group without any doc_id
    rows += [(None, base[10]), (None, base[10]), (40, base[4]), (41, " " + base[4]), (42, None), (None, "")]
    return [(i, t, "en", "abc"[n % 3], None if t is None else len(t)) for n, (i, t) in enumerate(rows)]


def brute_exact(rows):
    best = {}
    for r in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")
        rank = (-len(r[1] or ""), r[0] is None, r[0] or 0)
        if norm not in best or rank < best[norm][0]:
            best[norm] = rank, r
    return [r for _, r in best.values()]


def brute_near(rows):
    prints = [brute_print(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    best = {}
    for n, r in enumerate(rows):
        text = f"{'' if r[0] is None else r[0]}|{r[1] or ''}".encode()
        rank = (r[0] is None, r[0] or 0, hashlib.sha256(text).digest())
        if find(n) not in best or rank < best[find(n)][0]:
            best[find(n)] = rank, r
    return [r for _, r in best.values()]


def brute_mix(rows):
    chars = Counter()
    for r in rows:
        chars[r[3]] += max(len(r[1] or ""), 1)
    weight = {s: math.sqrt(n) for s, n in chars.items()}
    out = []
    for r in rows:
        rate = round(weight[r[3]] / sum(weight.values()) * sum(chars.values()) / chars[r[3]], 6)
        t = hashlib.md5((r[1] or "").encode()).hexdigest()
        u = int(hashlib.md5(f"42|count|{'' if r[0] is None else r[0]}|{t}".encode()).hexdigest()[:13], 16) / 2 ** 52
        term = cum = math.exp(-rate)
        n = 0
        while cum <= u:
            n += 1
            term *= rate / n
            cum += term
        out += [r] * n
    return out


def test_one_of_each_near_group(spark):
    rows = raw()
    got = simhash_tiles.keep_one_of_each(spark.createDataFrame(rows, DOCS))
    # Null and empty texts without other differences are one text.
    assert Counter((r.doc_id, r.text or "") for r in got.collect()) == Counter((r[0], r[1] or "") for r in brute_near(rows))


def test_run(spark, tmp_dir):
    rows = raw()
    spark.createDataFrame(rows, DOCS).write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(os.path.join(tmp_dir, "labels.parquet"))
    sp = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.TOKENIZER)
    want = Counter((r[0], r[2], r[3], tuple(sp.encode(r[1] or ""))) for r in brute_mix(brute_near(brute_exact(rows))))
    got = Counter((r.doc_id, r.lang, r.source, tuple(r.ids)) for r in corpus_pipeline.run(spark, tmp_dir).collect())
    assert got == want and len(want) > 5
