"""The registered queries op1, op3 and op6 against the same steps in plain loops over the whole small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict
from urllib.parse import urlsplit

import pytest
import zstandard

from conftest import SF_SMALL
from llm.test_toxicity import plain_features
from pricelens.llm import compress_quality, html_template, toxicity
from pricelens.llm.queries import op1_html_text, op3_quality, op6_toxicity

SF = "/root/testdata/sf0.01"


def test_html_templates_counted_in_loops(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    on_pages = defaultdict(set)
    parsed = {}
    for n, p in enumerate(pages):
        host = (urlsplit(p.url or "").hostname or "") if "://" in (p.url or "") else ""
        blocks, chains, marks = html_template.page_blocks(p.html)
        same = (host, tuple(blocks), tuple(chains), tuple(marks))  # pages that show the same count once
        for m in marks:
            on_pages[host, m].add(hash(same))
        parsed[n] = host, blocks, chains, marks
    want = Counter()
    for n, p in enumerate(pages):
        host, blocks, chains, marks = parsed[n]
        dead = {i for i, m in enumerate(marks) if len(on_pages[host, m]) >= html_template.MIN_PAGES}

        def deleted(chain):
            while chain >= 0:
                if chains[chain][0] in dead:
                    return True
                chain = chains[chain][1]
            return False

        left = [(t, rule) for t, chain, rule in blocks if not deleted(chain)]
        inner = [t for t, rule in left if rule == html_template.KEPT]
        text = "\n".join(inner or [t for t, rule in left if rule == html_template.OUTSIDE])
        want[p.page_id, p.url, text, len(text)] += 1
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in op1_html_text(spark, SF).collect())
    assert got == want


def logistic(model, x):
    z = [(v - m) / d for v, m, d in zip(x, model["mean"], model["dev"])]
    t = model["beta"][0] + sum(b * v for b, v in zip(model["beta"][1:], z))
    return 1 / (1 + math.exp(-max(min(t, 35), -35)))


def test_quality_scored_in_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = compress_quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert "constant" not in model

    def size(dictionary, text):
        c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), level=3, write_checksum=False,
                                     write_content_size=False, write_dict_id=False)
        return sum(len(c.compress(text[i:i + 2048])) for i in range(0, len(text), 2048))

    got = {r.doc_id: r for r in op3_quality(spark, SF).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows[::7]:
        text = (r.text or "").encode()
        n, g, b = (max(float(v), 1.0) for v in (len(text), size(model["good"], text), size(model["bad"], text)))
        by_size, by_length = (b - g) / (b + g), (b - g) / n
        ratio, long = math.log(min((g + b) / (2 * n), 4.0)), math.log(min(n, 4096.0))
        x = [by_size, by_length, ratio, long, by_size ** 2, ratio ** 2, by_size * ratio, ratio * long, by_size * long,
             min(ratio, -1.5), min(ratio, -2.5)]
        s = logistic(model["logistic"], x)
        assert got[r.doc_id].score == pytest.approx(s, abs=1e-9) and got[r.doc_id].predicted == int(s >= 0.3)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_toxicity_scored_in_loops(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert "constant" not in model
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    known = re.compile("|".join(re.escape(t.rstrip("*")[:4]) for t in model["terms"]))
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in [r for r in rows if known.search(r.text.lower())][:40] + rows[:10]:
        s = logistic(model["logistic"], plain_features(r.text, model["terms"], set(model["ordinary"]), model["near"]))
        assert got[r.doc_id].score == pytest.approx(s, abs=1e-9) and got[r.doc_id].predicted == int(s >= 0.5)
    assert op6_toxicity(spark, SF_SMALL).count() == len(rows)
