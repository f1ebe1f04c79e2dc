"""Toxicity scores from a lexicon matched with misspellings and read in context.

The lexicon is learned: words and stems far more frequent in labelled toxic texts than in
clean ones, in each of two halves of the texts, each with the logarithm of that ratio as its weight.
It is kept as a trie. Misspelled terms are found by running a Levenshtein automaton against the
trie: a state is the set of (trie node, edits left) that a word's letters so far can reach, computed
once per state and letter and then a table lookup; most words reach the dead state after three or
four letters. Variants that clean texts use as words of their own are not misspellings. How much a
misspelling of a term weighs is fitted by itself: on the variants in each half of the texts that clean
texts of the other half do not use. Variants need the evidence of a term; a term whose variants lack it
has no misspellings, and there are none at all if the calibration tells unseen texts no better with them.

Each hit is read in a window of ``CONTEXT`` words: with quotation marks on both sides in the window or
beside a word of reporting it is a quotation, beside a word of address it is abuse. Sums of the hits'
weights by kind, and their density, are calibrated by logistic regression.

Scale: fitting reads a bounded sample (``TOXIC_SAMPLE`` and ``CLEAN_SAMPLE`` labelled rows,
broadcast ids) and keeps at most ``MAX_TERMS`` terms (those in most toxic texts; the lexicon's
capacity) and the sample's variants of them; scoring is one narrow pass over whole texts, no
shuffle. The automaton's table is bounded by ``MAX_STATES`` and begun anew beyond.

Defined cases: a null text counts as empty; texts without words have zero features; without
labelled rows of one class every row gets the share of label 1 (0.0 without any labels); a
null doc_id is held out; repeated rows each get their row; of several labels for a document
the smallest counts. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.labelled import apply_logistic, fit_logistic, remainder, sample_labels, training_labels

TOXIC_SAMPLE, CLEAN_SAMPLE = 6000, 12_000
MAX_TERMS, MAX_STATES = 2000, 200_000
STEMS = (4, 5, 6, 7)  # lengths of word beginnings that may be terms, written with a star
MIN_WEIGHT, MIN_EVIDENCE = 2.5, 24.0  # log ratio, and likelihood ratio statistic, of a term
HALF_WEIGHT, HALF_EVIDENCE = 1.5, 5.0  # and at least these in each half of the texts
STEM_OWED = 0.8
CONTEXT = 6

WORD = re.compile(r"\w+(?:[*@$!]\w+)*|[\"“”„«»]")
QUOTES = frozenset('"“”„«»')
SPARK_WORD = r"(?U)\w+(?:[*@$!]\w+)*"
LOOKALIKE = str.maketrans("013457@$!", "oieastasi")  # fixed values: digits and signs written for letters
# Words of address and of reporting in the languages of the corpus.
ADDRESS = frozenset("you your youre u ur ye du dich dir euch ihr tu te toi vous tú usted ustedes vosotros".split())
REPORTING = frozenset(
    "said says called wrote quoted quote quoting word term sagte nannte schrieb zitat wort dit appelé écrit citation mot "
    "dijo llamó escribió cita palabra".split())


def edits_of(term: str) -> int:
    """Edits allowed in a misspelling of a term."""
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


# ---- trie and automaton ------------------------------------------------------------------


class Automaton:
    """Levenshtein automata of all terms at once: deterministic, its table filled as it is used."""

    DEAD = -1

    def __init__(self, terms: dict[str, float]):
        self.kids: list[dict[str, int]] = [{}]
        self.end: list[str | None] = [None]
        self.budget: list[int] = [0]  # most edits any term below the node allows
        for term in sorted(terms):
            node = 0
            allowed = edits_of(term)
            self.budget[0] = max(self.budget[0], allowed)
            for c in term:
                nxt = self.kids[node].get(c)
                if nxt is None:
                    nxt = len(self.kids)
                    self.kids[node][c] = nxt
                    self.kids.append({})
                    self.end.append(None)
                    self.budget.append(0)
                node = nxt
                self.budget[node] = max(self.budget[node], allowed)
            self.end[node] = term
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accept: list[tuple[str, int] | None] = []
        self.start = self._state(self._closure({0: 0}))

    def _closure(self, reach: dict[int, int]) -> frozenset:
        """(node, edits used) with skipped term letters added; the fewest edits of each node."""
        todo = list(reach.items())
        while todo:
            node, used = todo.pop()
            if reach.get(node) != used:
                continue
            for kid in self.kids[node].values():
                if used + 1 <= self.budget[kid] and used + 1 < reach.get(kid, 99):
                    reach[kid] = used + 1
                    todo.append((kid, used + 1))
        return frozenset((n, u) for n, u in reach.items() if u <= self.budget[n])

    def _state(self, key: frozenset) -> int:
        if not key:
            return self.DEAD
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            ends = [(u, self.end[n]) for n, u in key if self.end[n] is not None and u <= edits_of(self.end[n])]
            best = min(ends, default=None)
            self.accept.append((best[1], best[0]) if best else None)
        return found

    def _move(self, state: int, c: str) -> int:
        reach: dict[int, int] = {}

        def add(node, used):
            if used <= self.budget[node] and used < reach.get(node, 99):
                reach[node] = used

        for node, used in self.sets[state]:
            add(node, used + 1)  # a letter too many
            for letter, kid in self.kids[node].items():
                add(kid, used if letter == c else used + 1)
        to = self._state(self._closure(reach))
        self.moves[state][c] = to
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the closest term within its allowed edits, or None."""
        if len(self.sets) > MAX_STATES:
            self._reset()
        state = self.start
        moves = self.moves
        for c in word:
            nxt = moves[state].get(c)
            if nxt is None:
                nxt = self._move(state, c)
            if nxt < 0:
                return None
            state = nxt
        return self.accept[state]


# ---- features of a text ------------------------------------------------------------------

N_FEATURES = 8


class Reader:
    def __init__(self, terms: dict[str, float], ordinary: set[str], near: dict[str, float] | None = None):
        """``near``: weights of misspellings by term (none: the terms' own)."""
        self.terms, self.ordinary = terms, ordinary
        self.near = terms if near is None else near
        self.automaton = Automaton({t: w for t, w in terms.items() if t[-1] != "*"})
        self.stems = [n for n in STEMS if any(len(t) == n + 1 and t[-1] == "*" for t in terms)]

    def hit(self, word: str) -> tuple[str, int] | None:
        """(term, edits) if the word is a term or a misspelling of one."""
        if word in self.terms:
            return word, 0
        for n in self.stems:
            if len(word) > n and (stem := word[:n] + "*") in self.terms:
                return stem, 0
        if word in self.ordinary:
            return None
        found = self.automaton.match(word)
        if found is None and not word.isalpha():
            plain = word.translate(LOOKALIKE)
            found = (plain, 1) if plain in self.terms else None
        return found if found and found[0] in self.near else None

    def weight(self, term: str, edits: int) -> float:
        return self.near[term] / (1 + edits) if edits else self.terms[term]

    def hits(self, text: str) -> tuple[list[tuple[str, str, int, bool, bool]], int]:
        """((word, term, edits, quoted, addressed) of each hit, number of words)."""
        tokens = WORD.findall(text.lower())
        found = []
        hit = self.hit
        for at, word in enumerate(tokens):
            if (m := hit(word)) is None:
                continue
            before, after = tokens[max(0, at - CONTEXT): at], tokens[at + 1: at + CONTEXT + 1]
            near = {*before, *after}
            quoted = (not QUOTES.isdisjoint(before) and not QUOTES.isdisjoint(after)) or not REPORTING.isdisjoint(near)
            found.append((word, *m, quoted, not ADDRESS.isdisjoint(near)))
        return found, len(tokens)

    def features(self, text: str) -> list[float]:
        hits, n = self.hits(text) if text else ([], 0)
        exact = sum(self.terms[t] for _, t, e, q, _ in hits if not e and not q)
        near = sum(self.weight(t, e) for _, t, e, q, _ in hits if e and not q)
        quoted = sum(self.weight(t, e) for _, t, e, q, _ in hits if q)
        abuse = sum(self.weight(t, e) for _, t, e, q, a in hits if a and not q)
        kinds = len({t for _, t, _, q, _ in hits if not q})
        # Misspelled hits share the exact hits' coefficients; the second feature corrects for their precision.
        total = exact + near
        return [math.log1p(total), math.log1p(near), math.log1p(quoted), math.log1p(abuse), math.log1p(kinds),
                min(total / (n + 20), 1.0), float(total > 0), math.log1p(n)]


# ---- fitting -----------------------------------------------------------------------------


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, toxic, clean, toxic_half, clean_half): in how many different texts of each class a word
    occurs, in all and in one half of the texts.

    Stems (the first letters of a word, and "*") count as words. Texts count as different by
    the least hash of their word pairs, so a text's near copies count once or twice and not
    by the thousand.
    """
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(SPARK_WORD), F.lit(0))
    pairs_hash = F.array_min(F.zip_with("w", F.slice("w", 2, F.size("w")), lambda a, b: F.xxhash64(a, b)))
    listed = rows.select("y", words.alias("w")).filter(F.size("w") > 0).select(
        "y", F.array_distinct("w").alias("w"), pairs_hash.alias("print"))

    def stems(x):
        return F.filter(F.array(*(
            F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("*"))) for n in STEMS)), lambda p: p.isNotNull())

    both = F.concat("w", F.flatten(F.transform("w", stems)))
    pairs = listed.select("y", "print", F.explode(F.array_distinct(both)).alias("word")).distinct()
    half = F.when(F.pmod(F.xxhash64("print"), F.lit(2)) == 0, 1).otherwise(0)
    return pairs.groupBy("word").agg(
        F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"),
        F.sum(half * F.col("y")).alias("toxic_half"), F.sum(half * (1 - F.col("y"))).alias("clean_half"))


def evidence(k: int, n: int, j: int, m: int) -> float:
    """Likelihood ratio statistic of k in n against j in m."""

    def part(x, e):
        return x * math.log(x / e) if x else 0.0

    both = (k + j) / (n + m)
    return 2 * (part(k, n * both) + part(j, m * both) + part(n - k, n * (1 - both)) + part(m - j, m * (1 - both)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", toxic_sample: int = TOXIC_SAMPLE,
        clean_sample: int = CLEAN_SAMPLE) -> dict:
    """Lexicon, ordinary words near it, and calibration; or a constant score without both classes."""
    ids, counts = sample_labels(training_labels(labels, label), {0: clean_sample, 1: toxic_sample})
    total = sum(counts.values())
    constant = {"constant": counts[1] / total if total else 0.0}
    if not all(counts.values()):
        return constant
    # One row per sampled document: of rows that share a doc_id the smallest text counts.
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    by_word = word_counts(rows)
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n, m = sizes.get(1, 0), sizes.get(0, 0)
    if not n or not m:
        return constant
    by_word = by_word.persist()
    try:
        weight = F.log((F.col("toxic") + 0.5) / (n + 1)) - F.log((F.col("clean") + 0.5) / (m + 1))
        top = (by_word.filter((F.col("toxic") >= 3) & (F.length("word") >= 3)).withColumn("weight", weight)
               .filter(F.col("weight") >= MIN_WEIGHT).orderBy(F.col("toxic").desc(), "word").limit(4 * MAX_TERMS).collect())
        terms = {r["word"]: r["weight"] for r in top if says(r["toxic"], n, r["clean"], m, MIN_WEIGHT, MIN_EVIDENCE) and all(
            says(k, n / 2, j, m / 2, HALF_WEIGHT, HALF_EVIDENCE) for k, j in halves(r))}
        terms = own_stems(terms, {r["word"]: r["toxic"] for r in top})
        terms = dict(list(terms.items())[:MAX_TERMS])
        if not terms:
            return constant
        variants = variant_words(by_word, terms)
    finally:
        by_word.unpersist()
    model = {"terms": terms, "ordinary": [v["word"] for v in variants if v["clean"]], "near": near_weights(variants, terms, n, m)}
    part = (F.col("y") + 2 * F.pmod(F.xxhash64("doc_id"), F.lit(2))).cast("int").alias("part")

    def calibrated(model: dict) -> tuple[float, dict]:
        """(loss on each half of the rows when fitted on the other, model with its calibration on all)."""
        data = np.array([tuple(r) for r in read_features(rows.select(part, "text"), "part int", model).collect()])
        y, half, x = data[:, 0] % 2, data[:, 0] // 2, data[:, 1:]  # N_FEATURES numbers of each sampled row
        weights = np.where(y == 1, counts[1] / n, counts[0] / m)
        weights *= len(y) / weights.sum()
        loss = 0.0
        for h in (0, 1):
            here = half == h
            if here.all() or not here.any():
                continue
            p = np.clip(apply_logistic(fit_logistic(x[~here], y[~here], weights[~here]), x[here]), 1e-9, 1 - 1e-9)
            loss -= (weights[here] * np.log(np.where(y[here] == 1, p, 1 - p))).sum()
        return loss, model | {"logistic": fit_logistic(x, y, weights)}

    # Misspellings count only if texts that the calibration has not seen are told better with them.
    plain = calibrated(model | {"near": {}})
    both = calibrated(model) if model["near"] else plain
    return (both if both[0] < plain[0] else plain)[1]


def own_stems(terms: dict[str, float], toxic: dict[str, int]) -> dict[str, float]:
    """The terms without the stems that owe most of their texts to one term that is a word or a longer stem."""
    def owed(stem: str) -> bool:
        return any(t != stem and t.rstrip("*").startswith(stem[:-1]) and toxic[t] >= STEM_OWED * toxic[stem] for t in terms)

    return {t: w for t, w in terms.items() if t[-1] != "*" or not owed(t)}


def log_ratio(k: int, n: float, j: int, m: float) -> float:
    return math.log((k + 0.5) / (n + 1)) - math.log((j + 0.5) / (m + 1))


def says(k: int, n: float, j: int, m: float, weight: float, least: float) -> bool:
    """Whether k of n toxic against j of m clean texts make a word a sign of toxicity."""
    k, j = min(k, n), min(j, m)
    return log_ratio(k, n, j, m) >= weight and evidence(k, n, j, m) >= least


def halves(r) -> list[tuple[int, int]]:
    """(toxic, clean) counts of a word in either half of the texts."""
    return [(r["toxic_half"], r["clean_half"]), (r["toxic"] - r["toxic_half"], r["clean"] - r["clean_half"])]


def variant_words(by_word: DataFrame, terms: dict[str, float]) -> list:
    """The sample's words that the automaton takes for misspelled terms, with their counts and ``term``."""

    def run(batches):
        automaton = Automaton({t: w for t, w in terms.items() if t[-1] != "*"})
        for batch in batches:
            found = [None if w in terms or w[-1] == "*" else automaton.match(w) for w in batch.column(0).to_pylist()]
            named = batch.append_column("term", pa.array([f and f[0] for f in found], pa.string()))
            yield named.filter(pa.array([f is not None for f in found], pa.bool_()))

    names = ["word", "toxic", "clean", "toxic_half", "clean_half"]
    return by_word.select(*names).mapInArrow(run, "word string, toxic long, clean long, toxic_half long, clean_half long, term string").collect()


def near_weights(variants: list, terms: dict[str, float], n: int, m: int) -> dict[str, float]:
    """The weight of a misspelling of each term, from the variants in each half that the other half's
    clean texts do not use; terms whose variants are no sign of toxicity are left out."""
    seen: dict[str, list[int]] = {}
    for v in variants:
        one, two = halves(v)
        total = seen.setdefault(v["term"], [0, 0])
        for (k, j), (_, other) in ((one, two), (two, one)):
            if not other:
                total[0] += k
                total[1] += j
    return {t: min(log_ratio(k, n, j, m), terms[t]) for t, (k, j) in seen.items() if says(k, n, j, m, MIN_WEIGHT, MIN_EVIDENCE)}


def read_features(rows: DataFrame, first: str, model: dict) -> DataFrame:
    """The first column of ``rows`` and the features of its second column, the text."""
    name = first.split()[0]
    parts = {k: model[k] for k in ("terms", "ordinary", "near")}

    def run(batches):
        reader = Reader(parts["terms"], set(parts["ordinary"]), parts["near"])
        for batch in batches:
            if batch.num_rows:
                found = np.array([reader.features(t.as_py() or "") for t in batch.column(1)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(found[:, i]) for i in range(N_FEATURES))],
                    names=[name, *(f"f{i}" for i in range(N_FEATURES))])

    schema = ", ".join([first, *(f"f{i} double" for i in range(N_FEATURES))])
    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per document."""
    if "constant" in model:
        scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(model["constant"]).alias("score"))
    else:
        def run(batches):
            reader = Reader(model["terms"], set(model["ordinary"]), model["near"])
            for batch in batches:
                if batch.num_rows:
                    found = np.array([reader.features(t.as_py() or "") for t in batch.column(1)])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.array(apply_logistic(model["logistic"], found))], names=["doc_id", "score"])

        scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            run, "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
