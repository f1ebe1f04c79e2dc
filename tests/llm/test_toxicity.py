"""Features of the toxicity reader against plain code, quotation in the window, and what misspellings weigh."""

import math
import random
import re

import pytest

from pricelens.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def plain_hit(word, terms, ordinary, near):
    if word in terms:
        return word, 0
    for n in range(4, 8):
        if len(word) > n and word[:n] + "*" in terms:
            return word[:n] + "*", 0
    if word in ordinary:
        return None
    found = min(((distance(word, t), t) for t in terms if t[-1] != "*" and distance(word, t) <= toxicity.edits_of(t)), default=None)
    if found is None and not word.isalpha():
        letters = "".join(dict(zip("013457@$!", "oieastasi")).get(c, c) for c in word)
        found = (1, letters) if letters in terms else None
    return (found[1], found[0]) if found and found[1] in near else None


def plain_features(text, terms, ordinary, near):
    tokens = re.findall(r"\w+(?:[*@$!]\w+)*|[\"“”„«»]", text.lower())
    sums = {"exact": 0.0, "near": 0.0, "quoted": 0.0, "abuse": 0.0}
    kinds = set()
    for at, word in enumerate(tokens):
        hit = plain_hit(word, terms, ordinary, near)
        if hit is None:
            continue
        term, edits = hit
        weight = near[term] / (1 + edits) if edits else terms[term]
        left = [t for i, t in enumerate(tokens) if at - 6 <= i < at]
        right = [t for i, t in enumerate(tokens) if at < i <= at + 6]
        marks = '"“”„«»'
        if any(t in marks for t in left) and any(t in marks for t in right) or set(left + right) & toxicity.REPORTING:
            sums["quoted"] += weight
            continue
        sums["near" if edits else "exact"] += weight
        kinds.add(term)
        if set(left + right) & toxicity.ADDRESS:
            sums["abuse"] += weight
    total = sums["exact"] + sums["near"]
    return [math.log1p(total), math.log1p(sums["near"]), math.log1p(sums["quoted"]), math.log1p(sums["abuse"]), math.log1p(len(kinds)),
            min(total / (len(tokens) + 20), 1.0), float(total > 0), math.log1p(len(tokens))]


def test_features_match_plain_code():
    terms = {"idiot": 5.0, "worthless": 4.5, "scum": 4.0, "lowe*": 3.0, "moron": 2.7}
    near = {"idiot": 2.0, "worthless": 1.5}
    ordinary = {"idiom", "idiots"}
    reader = toxicity.Reader(terms, ordinary, near)
    rnd = random.Random(3)
    pool = ["idiot", "1d10t", "idoit", "idiom", "idiots", "worthles", "wortless", "scum", "scam", "lowered", "low", "moron", "maron", "you",
            "said", '"', "«", "»", "calm", "reed", "und", "w" * 60, "wort", "i", "idi0t"]
    for _ in range(400):
        text = " ".join(rnd.choice(pool) for _ in range(rnd.randrange(40)))
        assert reader.features(text) == pytest.approx(plain_features(text, terms, ordinary, near))
    assert reader.features("") == [0.0] * 8


def test_a_stray_mark_does_not_quote_the_rest():
    reader = toxicity.Reader({"idiot": 5.0}, set())
    calm = "reed moss fern oak elm ash yew "
    assert reader.hits('"' + calm * 3 + "idiot " + calm * 3 + '"')[0][0][3] is False
    assert reader.hits(f'{calm} the sign "what an idiot" {calm}')[0][0][3] is True
    assert reader.hits(f"{calm} an idiot {calm}")[0][0][3] is False


def corpus(n=3000):
    """Abuse, plain and misspelled, in toxic texts; quoted abuse and words like the terms in clean ones."""
    rnd = random.Random(8)
    rows, kinds = [], {}
    for i in range(n):
        filler = [f"w{rnd.randrange(4000)}" for _ in range(30)]
        term = rnd.choice(["moronic", "worthless", "disgusting"])
        cut = rnd.randrange(1, 4)
        wrong = term[:cut] + rnd.choice("qxzjkvbpfw") + term[cut:]
        kind = rnd.choices(("abuse", "misspelled", "quoted", "calm"), (40, 20, 1, 39))[0]
        middle = {"abuse": ["you", term], "misspelled": ["you", wrong], "quoted": ["he", "wrote", '"', term, '"', "there"],
                  "calm": ["you", "distrusting"]}[kind]
        rows.append((i, " ".join(filler[:15] + middle + filler[15:]), int(kind in ("abuse", "misspelled"))))
        kinds[i] = kind
    return rows, kinds


def test_misspellings_and_quotation_on_planted_texts(spark):
    rows, kinds = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert {"moronic", "worthless", "disgusting"} <= set(model["terms"]) and set(model["near"]) == {"moronic", "worthless", "disgusting"}
    reader = toxicity.Reader(model["terms"], set(model["ordinary"]), model["near"])
    quoted = [h for i, t, _ in rows if kinds[i] == "quoted" for h in reader.hits(t)[0] if h[3]]
    assert len(quoted) > 15

    def right(model):
        got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
        out = [(i, y) for i, _, y in rows if got[i].held_out]
        return sum(got[i].predicted == y for i, y in out) / len(out)

    assert right(model) >= 0.99 and right(dict(model, near={})) < 0.9


def test_stems_that_one_word_accounts_for_are_no_terms():
    terms = {"path*": 7.0, "pathetic": 7.0, "lowe*": 3.0, "lower": 3.0, "lowest": 3.0}
    toxic = {"path*": 50, "pathetic": 48, "lowe*": 60, "lower": 30, "lowest": 30}
    assert set(toxicity.own_stems(terms, toxic)) == {"pathetic", "lowe*", "lower", "lowest"}
