"""Near words, forms and roots against plain code over deletion neighbourhoods."""

import random
import re
import zlib
from collections import Counter, defaultdict

from conftest import SF_SMALL
from pricelens.llm import spelling_variants as spelling
from pricelens.llm.queries import op12_spelling


def near_pairs(words):
    """All ordered pairs one edit apart: words that are equal after one deletion at the same place, or by one deletion."""
    cut = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            cut[i, w[:i] + w[i + 1:]].add(w)
    out = set()
    for (_, rest), group in cut.items():
        out |= {(a, b) for a in group for b in group if a != b}
        if rest in words:
            out |= {(a, rest) for a in group} | {(rest, a) for a in group}
    return out


def plain_groups(n):
    near = defaultdict(list)
    for a, b in near_pairs(set(n)):
        near[a].append(b)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(str((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None)) for w in n)


def plain_counts(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def found(spark_rows):
    return sorted(str(tuple(r)) for r in spark_rows)


def test_query_matches_plain_code(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_spelling(spark, SF_SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    want = plain_groups(plain_counts(docs))
    assert len(want) > 1000 and found(got.collect()) == want


def test_random_words(spark):
    rnd = random.Random(5)
    for alphabet in ("ab", "abcdeé", "你好吗在哪里"):
        words = {"".join(rnd.choice(alphabet) for _ in range(rnd.randrange(4, 8))) for _ in range(500)}
        n = {w: 1 << rnd.randrange(12) for w in words}
        got = spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long"))
        assert found(got.collect()) == plain_groups(n)


def test_long_chain_of_forms(spark):
    # Each word is one replaced letter from the next and half as frequent; roots lie 25 steps away.
    chain = ["a" * i + "b" * (25 - i) for i in range(26)]
    n = {w: 3 << i for i, w in enumerate(chain)}
    got = spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert found(got.collect()) == plain_groups(n)
    assert {r.root for r in got.collect()} == {"a" * 25}


def test_long_words_of_one_letter(spark):
    n = {"x" * 3000: 3, "x" * 3001: 9, "x" * 1500 + "y" + "x" * 1500: 40, "y" + "x" * 2999: 5}
    got = spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert found(got.collect()) == plain_groups(n)


def test_pivots_are_disjoint_and_rare():
    counts = {spelling._bucket(g): c for g, c in (("ab", 1), ("bc", 2), ("cd", 3), ("de", 50), ("ef", 60))}
    prefix, pivots = spelling.prefix_and_pivots("abcdef", counts)
    assert [g[1] for g in prefix] == ["ab", "bc", "cd"] and pivots == (0, 2)
    prefix, pivots = spelling.prefix_and_pivots("aaaaaaa", {})
    assert len(prefix) == 6 and pivots == (0, 2)  # all places of one gram
    assert spelling.prefix_and_pivots("abc", {})[1] is None


def test_degenerate_documents(spark):
    text = "Straße STRASSE strase strase strasse strasse strasse ×÷×÷× "
    docs = [(1, None), (2, ""), (3, "12 !"), (None, text), (None, None), (4, text * 3), (4, text * 3), (5, "x" * 50_000), (6, "word" * 9)]
    d = spark.createDataFrame([(i, t, "w", 7) for i, t in docs], "doc_id long, text string, word string, n int")
    got = spelling.group_variants(spelling.word_counts(d, typos=True))
    assert found(got.collect()) == plain_groups(plain_counts(docs))
    empty = spelling.group_variants(spelling.word_counts(d.limit(0), typos=True))
    assert empty.count() == 0 and empty.columns == got.columns
