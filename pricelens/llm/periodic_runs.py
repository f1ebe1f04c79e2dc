"""Maximal periodic runs of words in each text.

A run is a stretch of words with smallest period q (words q apart are identical) and length
at least max(``LEAST``, 2 * q) that no neighbouring word extends keeping period q.

Method, for all texts of a batch at once, laid one after another with a unique word between:

* Periods below ``DIRECT``: lag scans. Words are compared with those q places on; a stretch
  of equal places is a run.
* Periods of [2^s, 2^(s+1)), scale by scale: grams of 2^(s-2) words are hashed, and the
  minima of windows that span 2^s words are kept. The first 2^s words of a run stand again q
  places on, and both windows keep the same minima (all of them where values tie), so some
  pair of equal minima stands q apart. Such pairs, nearest first, are extended both ways
  by comparing hashes of halving lengths; an extension that gives 2 * q words is a run.
* Two equal minima inside one known run whose period is at most the gram's length stand a
  multiple of its period apart and extend to that same run: such pairs are left out, which
  keeps texts of one repeated word linear. Of the pairs between two such runs of one period one
  for each distance is extended.

Runs from hashes are compared word by word before they count; a stretch found with several
periods keeps the smallest.

Scale: one narrow pass; a task holds ``SLICE`` bytes of text at a time or one longer text.

Defined cases: null and empty texts have no runs; fewer than ``LEAST`` words have none;
repeated rows each get their row, null doc_ids stay null. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import map_batches, split_batch

LEAST = 12  # words in the shortest run
DIRECT = 16  # periods below this are scanned lag by lag; a power of two, 4 at least
SLICE = 2 << 20
RUNS = "array<struct<start: long, length: long, period: long>>"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _double(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of 2 * n words from those of n words; the end wraps round, past the separators."""
    return _mix(h * np.uint64(0x9E3779B97F4A7C15) + np.roll(h, -n))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of each ``width`` values from a place on, wrapping round."""
    span = 1
    while 2 * span <= width:
        x = best(x, np.roll(x, -span))
        span *= 2
    return best(x, np.roll(x, span - width)) if span < width else x


def _stretches(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of consecutive numbers in sorted ``at``."""
    cut = np.flatnonzero(np.diff(at) != 1)
    first = np.concatenate([[0], cut + 1])
    last = np.concatenate([cut, [len(at) - 1]])
    return at[first], last - first + 1


def _lag_runs(ids: np.ndarray, lag: int) -> np.ndarray:
    same = np.flatnonzero(ids[lag:] == ids[:-lag])
    if not len(same):
        return np.empty((0, 3), np.int64)
    start, n = _stretches(same)
    enough = n >= max(lag, LEAST - lag)
    return np.stack([start[enough], n[enough] + lag, np.full(int(enough.sum()), lag)], axis=1)


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """How many words are the same from places ``a`` and ``b`` on, or before them."""
    size = len(levels[0])
    out = np.zeros(len(a), np.int64)
    active = np.arange(len(a))
    for j in range(len(levels) - 1, -1, -1):
        step = 1 << j
        while len(active):
            d = out[active] if forward else -out[active] - step
            equal = levels[j][(a[active] + d) % size] == levels[j][(b[active] + d) % size]
            out[active[equal]] += step
            if j < len(levels) - 1:
                break
            active = active[equal]
        active = np.arange(len(a))
    return out


def _known(runs: np.ndarray, size: int, gram: int) -> np.ndarray:
    """For each place the number of a run of period <= ``gram`` that holds the gram there, or -1."""
    out = np.full(size, -1, np.int64)
    for k, (start, n, period) in enumerate(runs):
        if period <= gram <= n:
            out[start:start + n - gram + 1] = k
    return out


def _pairs(values: np.ndarray, places: np.ndarray, inside: np.ndarray, low: int, high: int):
    """(places, lags, known runs of both places) of pairs with equal values, ``low`` to ``high - 1``
    apart, not inside one known run."""
    order = np.argsort(values, kind="stable")
    values, places, inside = values[order], places[order], inside[order]
    change = np.flatnonzero((values[1:] != values[:-1]) | (inside[1:] != inside[:-1]) | (inside[1:] < 0)) + 1
    change = np.append(change, len(values))
    partner = change[np.searchsorted(change, np.arange(len(values)), "right")] if len(values) else change[:0]
    active = np.arange(len(values))
    while True:
        keep = partner < len(values)
        active, partner = active[keep], partner[keep]
        lag = places[partner] - places[active]
        keep = (values[partner] == values[active]) & (lag < high)
        active, partner, lag = active[keep], partner[keep], lag[keep]
        if not len(active):
            return
        far = lag >= low
        if far.any():
            yield places[active[far]], lag[far], inside[active[far]], inside[partner[far]]
        partner = partner + 1


def _scale_runs(levels: list[np.ndarray], scale: int, known: np.ndarray) -> np.ndarray:
    low = 1 << scale
    gram = low >> 2
    h = levels[scale - 2]
    width = low - gram + 1
    least = _sliding(h, width, np.minimum)
    # A place is kept if it holds the least value of some window that covers it.
    most = np.roll(_sliding(least, width, np.maximum), width - 1)
    places = np.flatnonzero(most == h)
    found = [np.empty((0, 3), np.int64)]
    seen: dict[int, np.ndarray] = {}
    for place, lag, one, other in _pairs(h[places], places, _known(known, len(h), gram)[places], low, 2 * low):
        # Between two known runs of one period all pairs of one lag extend alike: the first of them is enough.
        new = np.ones(len(place), bool)
        alike = (one >= 0) & (other >= 0)
        alike[alike] = known[one[alike], 2] == known[other[alike], 2]
        code = np.where(alike, one * len(known) + other, -1)
        for c in np.unique(code[code >= 0]).tolist():
            lags = seen.setdefault(c, np.zeros(2 * low, bool))
            here = np.flatnonzero(code == c)
            new[here] = ~lags[lag[here]]
            lags[lag[here]] = True
        place, lag = place[new], lag[new]
        ahead = _common(levels, place, place + lag, True)
        behind = _common(levels, place, place + lag, False)
        n = ahead + behind
        enough = n >= lag
        found.append(np.unique(np.stack([(place - behind)[enough], (n + lag)[enough], lag[enough]], axis=1), axis=0))
    return np.unique(np.concatenate(found), axis=0)


def _smallest(runs: np.ndarray) -> np.ndarray:
    """One row for each stretch, with its smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def _is_run(ids: np.ndarray, start: int, n: int, lag: int) -> bool:
    end = start + n
    return (start >= 0 and end < len(ids) and bool((ids[start:end - lag] == ids[start + lag:end]).all())
            and (start == 0 or ids[start - 1] != ids[start - 1 + lag]) and ids[end - lag] != ids[end])


def find_runs(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All runs of texts laid one after another, each followed by a unique negative number.

    ``sizes`` counts the words of each text without that number. Rows are (start in ``ids``,
    length, period), sorted."""
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    longest = int(sizes.max(initial=0))
    runs = _smallest(np.concatenate([np.empty((0, 3), np.int64)] + [
        _lag_runs(ids, q) for q in range(1, min(DIRECT, longest // 2 + 1))]))
    scale = DIRECT.bit_length() - 1
    part, part_sizes, part_starts = ids, sizes, starts
    levels: list[np.ndarray] = []
    while 2 << scale <= longest:
        keep = part_sizes >= 2 << scale  # shorter texts have no room for such a period
        mask = np.repeat(keep, part_sizes + 1)
        part, levels = part[mask], [h[mask] for h in levels]
        part_sizes, part_starts = part_sizes[keep], part_starts[keep]
        if not levels:
            levels = [_mix(part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))]
        while len(levels) <= scale:
            levels.append(_double(levels[-1], 1 << (len(levels) - 1)))
        here = np.concatenate([[0], np.cumsum(part_sizes + 1)[:-1]])
        # Known runs, by their places in this part.
        home = np.searchsorted(part_starts, runs[:, 0], "right") - 1
        inside = (home >= 0) & (runs[:, 0] < (part_starts + part_sizes)[home])
        known = runs[inside].copy()
        known[:, 0] += (here - part_starts)[home[inside]]
        new = _scale_runs(levels, scale, known)
        wrong = np.array([not _is_run(part, *r) for r in new.tolist()], bool)
        if wrong.any():  # two different grams with one hash: scan those lags word by word
            new = np.concatenate([new[~wrong]] + [_lag_runs(part, q) for q in set(new[wrong, 2].tolist())])
        if len(new):
            home = np.searchsorted(here, new[:, 0], "right") - 1
            new[:, 0] += (part_starts - here)[home]
            runs = _smallest(np.concatenate([runs, new]))
        scale += 1
    return runs


def _texts_runs(part: pa.RecordBatch) -> pa.RecordBatch:
    numbers: dict = {}
    texts = [(t or "").encode().split() for t in part.column("text").to_pylist()]  # exactly [\x20\x09-\x0D]
    sizes = np.array([len(t) for t in texts], np.int64)
    number = count()
    for w in chain.from_iterable(texts):
        if w not in numbers:
            numbers[w] = next(number)
    total = int(sizes.sum())
    ids = np.empty(total + len(texts), np.int64)
    ends = np.cumsum(sizes + 1) - 1
    word = np.ones(len(ids), bool)
    word[ends] = False
    ids[word] = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, total)
    ids[ends] = -1 - np.arange(len(texts))
    runs = find_runs(ids, sizes)
    starts = ends - sizes
    home = np.searchsorted(starts, runs[:, 0], "right") - 1
    # A text without words shares its start with no run, as its one place is a separator.
    drop = np.zeros(len(ids) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(drop)[:-1] > 0
    per_text = np.bincount(home, minlength=len(texts))
    collapsed = []
    for k, t in enumerate(texts):
        if per_text[k]:
            t = [w for w, d in zip(t, dropped[starts[k]:ends[k]].tolist()) if not d]
        collapsed.append(b" ".join(t).decode())
    offsets = pa.array(np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32))
    values = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - starts[home]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(sizes), pa.ListArray.from_arrays(offsets, values), pa.array(collapsed, pa.string())],
        ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): each text's runs by start and period, and its words
    joined by one space without those that a run repeats after its first period."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batch):
        for part in split_batch(batch, "text", SLICE):
            yield _texts_runs(part)

    return map_batches(rows, run, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def with_echoes(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts of which one in ten repeats a stretch of its words to its end.

    With h the crc32 of the decimal doc_id (null: of the empty text) and g = h / 10: where 10
    divides h, each word i >= a becomes word a + (i - a) % p of the n words, with a = g % n
    and p = 1 + (n - a) / (3 + g % 8), whole parts of the quotients."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    g = F.floor(h / 10)

    def echo(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(
            F.element_at(words, (F.lit(1) + a + (i - a) % p).cast("int")))), " ")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    bound = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, echo(w)).otherwise(F.lit("")))
    text = F.when((h % 10 == 0) & F.col("text").isNotNull(), F.element_at(bound, 1)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """One row per text: the number of runs, the longest run, and digests of the runs and of the collapsed text."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))), "")
    top = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    has = F.size("runs") > 0
    first = F.when(has, top)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), first["start"].alias("start"),
        (-first["less"]).alias("length"), first["period"].alias("period"),
        F.floor(-first["less"] * 1000 / first["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.when(has, lines).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
