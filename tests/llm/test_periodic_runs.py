"""Periodic runs against a scan of all lags, and the echoes and digests against plain code."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from conftest import SF_SMALL
from pricelens.llm import periodic_runs as runs
from pricelens.llm.queries import op13_periodic_runs


def all_lags(words):
    """(start, length, period) of every run, by comparing words at every lag."""
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(runs.LEAST, 2 * q):
                best.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in best.items())


def made_texts(rnd):
    kind = rnd.random()
    letters = rnd.choice([1, 2, 2, 3, 5, 50])
    x = [rnd.randrange(letters) for _ in range(rnd.randrange(400))]
    if kind < 0.3 and len(x) > 5:
        a = rnd.randrange(len(x))
        p = 1 + (len(x) - a) // rnd.randrange(2, 9)
        x = [x[i] if i < a else x[a + (i - a) % p] for i in range(len(x))]
    elif kind < 0.6:
        u = [rnd.randrange(letters) for _ in range(rnd.randrange(1, 6))]
        v = [rnd.randrange(letters) for _ in range(rnd.randrange(1, 4))]
        x = ((u * rnd.randrange(1, 30) + v) * rnd.randrange(1, 6) + u * rnd.randrange(40) + v)[:rnd.randrange(1, 800)]
    elif kind < 0.7:
        x = [0, 1] * rnd.randrange(1, 80) + [1, 0] * rnd.randrange(1, 80)
    elif kind < 0.8:
        a, x = [0], [0, 1]
        for _ in range(rnd.randrange(1, 12)):
            a, x = x, x + a
    return x


@pytest.mark.parametrize("seed", range(4))
def test_runs_match_all_lags(seed):
    rnd = random.Random(seed)
    for _ in range(25):
        texts = [made_texts(rnd) for _ in range(rnd.randrange(1, 15))]
        sizes = np.array([len(t) for t in texts])
        ids = np.array([w for k, t in enumerate(texts) for w in t + [-1 - k]])
        starts = np.cumsum(sizes + 1) - sizes - 1
        want = sorted((int(s) + i, n, q) for t, s in zip(texts, starts) for i, n, q in all_lags(t))
        assert [tuple(r) for r in runs.find_runs(ids, sizes).tolist()] == want


def test_hash_ties_are_settled_word_by_word(monkeypatch):
    monkeypatch.setattr(runs, "_mix", lambda x: x & np.uint64(7))
    rnd = random.Random(9)
    for _ in range(10):
        t = made_texts(rnd)
        got = runs.find_runs(np.array(t + [-1]), np.array([len(t)])).tolist()
        assert set(map(tuple, got)) <= set(all_lags(t))


def plain(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = all_lags(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in found)]
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest())


def key(row):
    return str(tuple(row))


def test_query_matches_plain_code(spark):
    got = op13_periodic_runs(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = [plain(r.doc_id, r.text) for r in docs]
    assert any(w[1] for w in want)
    assert sorted(map(key, got.collect())) == sorted(map(str, want))


def test_degenerate_texts(spark):
    texts = [(1, None), (2, ""), (3, " \n"), (4, "a b c d"), (4, "a b c d"), (None, "x y " * 40), (None, None), (5, "w " * 30_000),
             (6, "a b " * 9 + "b a " * 9), (7, "é é " * 12), (8, "a" * 200_000)] + [(i, "u v w " * (i % 9)) for i in range(9, 60)]
    d = spark.createDataFrame([(i, t, 1, "r") for i, t in texts], "doc_id long, text string, start int, runs string")
    got = runs.digest(runs.periodic_runs(runs.with_echoes(d)))
    want = [plain(i, t) for i, t in texts if i != 5]
    rows = got.collect()
    assert sorted(key(r) for r in rows if r.doc_id != 5) == sorted(map(str, want))
    long = [r for r in rows if r.doc_id == 5]
    assert [(r.n_runs, r.start, r.length, r.period) for r in long] == [(1, 0, 30_000, 1)]
    empty = runs.digest(runs.periodic_runs(runs.with_echoes(d.limit(0))))
    assert empty.count() == 0 and empty.schema == got.schema
