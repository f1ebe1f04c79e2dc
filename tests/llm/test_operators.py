"""The text operators against brute force, SQL and round trips, and on degenerate tables."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
import sentencepiece
import xxhash

from conftest import SF_SMALL
from pricelens.llm import (
    chunk_recipes, compress_quality, html_template, piece_tokenizer, poisson_mix, repeat_spans, simhash_tiles, topk_segments,
    toxicity, warc_revisit,
)
from pricelens.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES, TOKENIZER

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, count int"


def docs(spark, texts):
    """Documents with nulls, ties, repeated rows and columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, None, None if n % 3 else "s", None, "x", 1) for n, (i, t) in enumerate(texts)], DOCS)


ODD = [(1, None), (2, ""), (3, " \n"), (4, "a b c d"), (4, "a b c d"), (None, "a b c d"), (5, "A  b c\td"), (6, "w " * 30_000),
       (7, "é" * 250), (None, None)]


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(LLM_ORACLE_SQL[name])
    cols = [c[0] for c in res.description]
    got = LLM_QUERIES[name](spark, SF_SMALL)
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, res.fetchall()))


def test_degenerate_documents(spark):
    for rows in (ODD, []):
        d = docs(spark, rows)
        n = len(rows)
        assert chunk_recipes.exact_groups(d).count() == n
        assert chunk_recipes.drop_exact_copies(d).columns == d.columns
        assert chunk_recipes.drop_exact_copies(d).count() == (5 if n else 0)  # empty, abcd, Abcd, www, é
        assert simhash_tiles.near_groups(d).count() == n
        assert simhash_tiles.keep_one_of_each(d).columns == d.columns
        assert repeat_spans.remove_repeats(d).count() == n
        assert set(d.columns) <= set(poisson_mix.mix(d).columns)
        assert poisson_mix.mix(d, weights={"absent": 1.0}).count() == 0
        labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
        assert compress_quality.score(d, compress_quality.fit(d, labels)).count() == n
        assert toxicity.score(d, toxicity.fit(d, labels)).count() == n


def brute_repeats(rows, length=100):
    first, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first.setdefault(b[p: p + length], (i, p)) != (i, p):
                gone[p: p + length] = b"\x01" * length
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def test_repeated_spans(spark):
    rnd = random.Random(7)
    base = ["".join(rnd.choice("abc ") for _ in range(400)) for _ in range(5)]
    rows = [(i, "".join(rnd.choice([rnd.choice(base)[rnd.randrange(300):], "xyz" * rnd.randrange(90), "a" * rnd.randrange(260),
                                    "".join(rnd.choice("abé") for _ in range(90))]) for _ in range(rnd.randrange(5))))
            for i in range(80)]
    rows += [(200, None), (201, ""), (202, "a" * 99), (203, "a" * 101), (204, rows[3][1]), (None, rows[3][1])]
    got = repeat_spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).drop("kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_repeats(rows)


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i: i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark):
    con = duckdb.connect()
    rows = con.execute(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    rows += [(900 + i, f"{rows[5][1]} tail{i}") for i in range(40)] + [(990, None), (991, "x")]
    prints = {i: brute_print(t) for i, t in rows}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = {(i, f"{prints[i]:016x}", find(i)) for i in ids}
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for tile in (4096, 2):  # two rows a tile: every group takes the salted cells
        assert {tuple(r) for r in simhash_tiles.near_groups(d, tile_rows=tile).collect()} == want


def test_simhash_links_of_dense_groups(spark):
    rnd = random.Random(3)
    center = rnd.getrandbits(64)
    fps = list({center ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(4))) for _ in range(600)})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r.root for r in simhash_tiles.components(simhash_tiles.links(df, 3, tile_rows=16)).collect()}
    assert roots == {min(signed)}


def test_top_k_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [float("nan"), 1.0]), (3, []), (4, [1e300, -1e300]), (5, [0.5, None]),
            (6, [1.0, 2.0, 3.0]), (7, [1.0, 2.0]), (None, [1.0, 1.0])]
    e = topk_segments.quantised_rows(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk_segments.top_k(e.filter("vec_id % 100 = 0"), e, k=2).orderBy("rank").collect()
    # The repeated row of vec_id 0 asks twice, as it does in the SQL.
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 6, 5 << 20), (0, 2, 6, 5 << 20)]
    once = topk_segments.top_k(e.filter("vec_id % 100 = 0").limit(1), e, k=2).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in once] == [(1, 6, 5 << 20), (2, 7, 5 << 20)]
    assert topk_segments.top_k(e.limit(0), e.limit(0)).count() == 0


def test_html(spark):
    page = ('<div id=wrap><header><h1>Site</h1></header><div class="menu">a</div><main><article><header><h1>T&eacute;st</h1><p>by X'
            '</p></header><p>One <b>two</b>\n three&nbsp;four<p>Five<ul><li>a<li>b</ul><div class="comments"><p>nice</p></div>'
            "<aside>x</aside><form><p>mail</p></form></article></main><footer>f</footer>")
    assert [t for t, _ in html_template.pieces(page)[0]] == ["Tést", "One two three four", "Five", "a", "b"]
    site = [(i, f"http://a.b/{i}", f"<div>Welcome to us</div><div><p>Body {i}</p></div><div>own {i}</div>") for i in range(8)]
    rows = site + [(8, None, None), (9, "", ""), (9, "", ""), (None, "x", "<p>c < d <broken")]
    got = html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {(r.page_id, r.text) for r in got} == {(i, f"Body {i}\nown {i}") for i in range(8)} | {
        (8, ""), (9, ""), (None, "c < d <broken")}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)


def test_revisits(spark):
    rec = [(1, "response", "http://WWW.a.b:80/x/?b=2&a=1#f", 10, {"ETag": '"1"', "Content-Type": "t", "Date": "1"}, "d1"),
           (2, "response", "https://a.b/x?a=1&b=2", 20, {"etag": '"2"'}, "d2"),
           (3, "revisit", "a.b/x?a=1&b=2", 15, {"ETag": 'W/"1"', "Content-Type": "z", "Date": "9"}, None),
           (4, "revisit", "a.b/x?a=1&b=2", 25, {"ETag": '"1"'}, None), (5, "revisit", "a.b/x?a=1&b=2", 10, None, None),
           (6, "revisit", "a.b/x?a=1&b=2", 30, None, "d2"), (7, "revisit", None, None, None, None)]
    df = spark.createDataFrame(rec, "record_id long, kind string, url string, ts long, headers map<string,string>, digest string")
    got = {r.record_id: (r.response_id, r.status, r.matched_by, r.headers) for r in warc_revisit.resolve(df, slots=3).collect()}
    assert got == {3: (1, "resolved", "etag", 'content-type: t\ndate: 9\netag: W/"1"'),
                   4: (2, "validator_mismatch", "etag", 'etag: "1"'), 5: (None, "no_earlier_response", None, ""),
                   6: (2, "resolved", "digest", 'etag: "2"'), 7: (None, "no_earlier_response", None, "")}
    assert warc_revisit.resolve(df.limit(0)).count() == 0


def test_tokenizer_parity(spark):
    data = piece_tokenizer.load_model(spark, TOKENIZER)
    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    rnd = random.Random(2)
    texts = ["", " ", "  a  b ", "\n\t x\n", "<s> hi </s>", "日本語 😀", "a" * 300, "▁x", None] + [
        "".join(rnd.choice("ab  \n-=.01é😀") for _ in range(rnd.randrange(60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = piece_tokenizer.encode(df, data)
    for r in out.collect():
        assert r.ids == sp.encode(texts[r.doc_id] or "") and r.parity and r.n_tokens == len(r.ids)
    back = {r.doc_id: r.text for r in piece_tokenizer.decode(out, data).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts) if "▁" not in (t or ""))


def test_misspelled_terms():
    terms = {"idiot": 5.0, "worthless": 5.0, "scum": 4.0, "lowe*": 3.0}
    reader = toxicity.Reader(terms, {"idiom"})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    rnd = random.Random(5)
    auto = toxicity.Automaton({t: w for t, w in terms.items() if "*" not in t})
    for _ in range(3000):
        w = list(rnd.choice(["idiot", "worthless", "scum", "other"]))
        for _ in range(rnd.randrange(4)):
            at = rnd.randrange(len(w) + 1)
            w[at: at + rnd.randrange(2)] = rnd.choice(["", "a", "o"])
        w = "".join(w)
        best = min((distance(w, t), t) for t in ("idiot", "worthless", "scum") if distance(w, t) <= toxicity.edits_of(t)) if any(
            distance(w, t) <= toxicity.edits_of(t) for t in ("idiot", "worthless", "scum")) else None
        assert auto.match(w) == (best and (best[1], best[0])), w
    assert reader.hit("idiom") is None and reader.hit("lowered") == ("lowe*", 0) and reader.hit("1d10t") == ("idiot", 1)
    assert reader.hits('he said "idiot" once')[0][0][3] and reader.hits("you idiot")[0][0][4]


@pytest.mark.parametrize("module, label", [(compress_quality, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy(spark, module, label):
    sf = "/root/testdata/sf0.1"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = module.score(d, module.fit(d, labels)).join(labels, "doc_id").filter("held_out")
    right, n = got.selectExpr(f"sum(int(predicted = {label})), count(*)".split(", ")[0], "count(*)").first()
    assert right / n > 0.96
