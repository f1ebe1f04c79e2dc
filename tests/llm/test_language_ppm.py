"""The language models against a plain PPM coder, on held-out documents and on degenerate tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pricelens.llm import language_ppm as ppm
from pricelens.llm.queries import op11_language


def coded_words(text):
    return [b" " * ppm.ORDER + w.encode() + b" " for w in re.findall(r"[^\W\d_]+", (text or "").lower())]


def plain_bits(train, text):
    """Bits of ``text`` by a dictionary of contexts of every order learnt from ``train``."""
    tree = defaultdict(Counter)
    for t in train:
        for w in coded_words(t):
            for i in range(ppm.ORDER, len(w)):
                for k in range(ppm.ORDER + 1):
                    tree[w[i - k:i]][w[i]] += 1
    bits = 0.0
    for w in coded_words(text):
        for i in range(ppm.ORDER, len(w)):
            for k in range(ppm.ORDER, -1, -1):
                seen = tree.get(w[i - k:i])
                if not seen:
                    continue
                total, kinds = sum(seen.values()), len(seen)
                if w[i] in seen:
                    bits -= math.log2(seen[w[i]] / (total + kinds))
                    break
                bits -= math.log2(kinds / (total + kinds))
            else:
                bits += 8
    return bits


VOICES = {"x": "the thing was here and there ", "y": "über schöne straße größer ", "z": "où çela était déjà là "}


def corpus(n=120):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        lang = "xyz"[i % 3]
        words = VOICES[lang].split()
        rows.append((i, " ".join(rnd.choice(words) + rnd.choice(["", "a", "é"]) for _ in range(rnd.randrange(1, 30))), lang))
    return rows


def test_code_lengths_match_a_plain_coder(spark):
    rows = corpus()
    model = ppm.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    assert model["langs"] == ["x", "y", "z"]
    assert model["prior"] == pytest.approx([-math.log2(sum(r[2] == g for r in train) / len(train)) for g in "xyz"])
    texts = [r[1] for r in rows] + ["", None, "Straße 12, THE-thing!", "ж" * 50, "a" * 5000, "déjà. déjà"]
    got = ppm.code_lengths(pa.array(texts, pa.string()), [ppm.Tree(*t) for t in model["trees"]])
    want = np.array([[plain_bits([r[1] for r in train if r[2] == g], t) for g in "xyz"] for t in texts])
    assert np.allclose(got, want)


def test_held_out_accuracy(spark):
    got = op11_language(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert got.count() == docs.count() == len(rows)
    out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang == r.lang_pred for r in out) >= 0.99 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_a_pruned_model_keeps_the_frequent_grams(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    whole, small = ppm.fit(docs), ppm.fit(docs, grams=60)
    assert small["langs"] == whole["langs"]
    for (grams, n), (all_grams, all_n) in zip(small["trees"], whole["trees"]):
        least = n.min()
        assert len(grams) <= 20 and set(grams) == set(all_grams[all_n >= 1 << (int(least).bit_length() - 1)])


@pytest.mark.parametrize("grams", [0, 60, 120])
def test_grams_that_are_not_broadcast_count_too(spark, grams):
    rows = corpus() + [(500, "ж" * 50 + " déjà", None), (501, None, "x"), (501, "12", "x"), (502, "straße Ünseen", None),
                       (503, "zyx", "w"), (503, "zyx", "w"), (504, "zyx", "w"), (None, "the 1 ż ż", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole, small = ppm.fit(docs), ppm.fit(docs, grams=grams)
    assert whole["counts"] is None and small["counts"] is not None
    assert sum(len(g) for g, _ in small["trees"]) <= grams and small["langs"] == whole["langs"]

    def found(model):
        return sorted((str(r.doc_id), r.held_out, r.lang_pred, round(r.score, 9), round(r.bits, 6))
                      for r in ppm.predict(docs, model).collect())

    assert found(small) == found(whole)


def test_degenerate_tables(spark):
    schema = "doc_id long, text string, lang string, held_out string, bits int, gram string"
    extra = ("h", 1, "g")
    rows = [(1, None, "x", *extra), (2, "", None, *extra), (3, " 12 !?", "y", *extra), (None, "the thing", "x", *extra),
            (4, "a" * 100_000, "x", *extra), (4, "a" * 100_000, "x", *extra), (5, "é", None, *extra), (None, None, None, *extra)]
    for some in (rows, [], [(7, "no labels", None, *extra)]):
        d = spark.createDataFrame(some, schema)
        got = ppm.predict(d, ppm.fit(d))
        assert got.columns == ["doc_id", "held_out", "lang_pred", "score", "bits"]
        assert got.count() == len(some)
        for r in got.collect():
            assert 0 <= r.score <= 1 and r.lang_pred in ("x", "y", "und")
            if r.doc_id in (1, 2, 3, 7):
                assert r.lang_pred == "und" and r.score == 0
