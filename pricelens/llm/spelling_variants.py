"""Grouping of spelling variants: words one edit apart, found by pivotal grams.

Two words are near if one inserted, deleted or replaced code point turns one into the other.
Every word's bigrams are ordered by how few words hold them; its gram prefix is the first
three in that order (with all places of the third's text). Two disjoint bigrams of the prefix
with the least total count, chosen by dynamic programming, are its pivots. One edit breaks
at most one of two disjoint pivots, so one of them stands unchanged in the near word, and,
if the last gram of the word's prefix does not come after that of the other's prefix, it
belongs to the other's prefix.

Position limit: a word is cut between its pivots, as near its middle as they allow. The edit
lies in one part, so the near word begins with the other part, or ends in it, and holds that
part's pivot at the same distance from that end. Each pivot is indexed with its part; the other
words' prefix grams are looked up with every beginning or end of the word that holds one. Words
whose lengths differ by more than one, or whose sets of letters differ by more than two, are
not compared; the edit distance decides.

Scale: words are counted with map-side combination. Gram counts are kept in ``BUCKETS``
buckets (the only thing collected and broadcast, 512 KB at most); a gram's place in the order
is its bucket's count and then its text. The index is one equi-join on the common text, whose
large partitions Spark splits; nothing lists the pairs of a group. Roots are found by pointer
doubling: a form is at least twice as frequent as its word, so chains are at most log2(n) long.

Defined cases: null texts have no words; a null doc_id counts as the empty text; repeated rows
count again; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import map_batches, split_batch, written

BUCKETS = 1 << 16
SLICE = 16 << 20  # bytes of text whose words are counted at a time
FLUSH = 16 << 20  # characters of index rows built at a time
PREFIX = 3  # q * tau + 1 grams for bigrams and one edit
NOT_A_WORD = "[^A-Za-zÀ-ÿ]+"
TYPO = 97


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def _crcs(first: np.ndarray, sizes: np.ndarray) -> dict[int, np.ndarray]:
    """For each size the part of the crc32 of a first text and one of ``size`` bytes that the first text
    gives: crc32(a + b) is the crc32 of a moved on by len(b) zero bytes, xor the crc32 of b."""
    table, out, wanted = _crc_table(), {}, set(sizes.tolist())
    for size in range(int(sizes.max(initial=0)) + 1):
        if size in wanted:
            out[size] = first
        first = table[first & 0xFF] ^ (first >> np.uint32(8))
    return out


def _typos(ids, words: pa.Array, index: np.ndarray, text_of: np.ndarray, letters: np.ndarray):
    """Which runs get a typing error, and what they become."""
    raw = words.cast(pa.binary()).to_pylist()
    sizes = np.array([len(w) for w in raw], np.int64)
    own = np.array([zlib.crc32(w) for w in raw], np.uint32)
    moved = _crcs(np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32), np.unique(sizes))
    rank = {size: k for k, size in enumerate(moved)}
    column = np.array([rank[size] for size in sizes.tolist()], np.int64)
    h = np.stack(list(moved.values()), axis=1)[text_of, column[index]] ^ own[index]
    hit = np.flatnonzero((h % TYPO == 0) & (letters[index] > 0))
    out = []
    for k in hit.tolist():
        word = raw[index[k]].decode()
        at = int(h[k]) % len(word)
        out.append(word[:at] + word[at + 1:])
    return hit, out


def word_counts(docs: DataFrame, least_length: int = 5, least_n: int = 3, typos: bool = False) -> DataFrame:
    """(word, n): the runs of letters of all texts, A-Z lower-cased, of at least ``least_length``
    code points and ``least_n`` occurrences.

    ``typos`` plants one typing error in about every 97th run: where 97 divides
    h = crc32("<doc_id>:<run>") the code point h % length is deleted."""

    def count(batch):
        for part in split_batch(batch, "text", SLICE):
            lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(part.column("text"), "")), NOT_A_WORD)
            coded = lists.flatten().dictionary_encode()
            words, index = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
            letters = pc.utf8_length(words).to_numpy(zero_copy_only=False)
            n = np.bincount(index, minlength=len(words))
            planted: list[str] = []
            if typos:
                text_of = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
                long = np.flatnonzero(letters[index] >= least_length)  # shorter runs become no words
                hit, planted = _typos(part.column("id").to_pylist(), words, index[long], text_of[long], letters)
                n -= np.bincount(index[long[hit]], minlength=len(words))
            keep = np.flatnonzero((letters >= least_length) & (n > 0))
            planted = [w for w in planted if len(w) >= least_length]
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([words.take(pa.array(keep)), pa.array(planted, pa.string())]),
                 pa.array(np.append(n[keep], np.ones(len(planted), np.int64)))], ["word", "n"])

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("string").alias("text"))
    return (map_batches(texts, count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n))


INDEX = pa.schema([("side", pa.string()), ("pivot", pa.bool_()), ("word", pa.string()), ("n", pa.int64()),
                   ("last", pa.string()), ("letters", pa.int64())])


def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode()) & (BUCKETS - 1)


def gram_counts(words: DataFrame) -> dict[int, int]:
    """How many grams of the words fall into each bucket; at most ``BUCKETS`` numbers."""
    grams = words.filter(F.length("word") > 1).select(F.explode(F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
    bucket = F.crc32("gram").bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
    return {r["bucket"]: r["count"] for r in grams.groupBy(bucket.alias("bucket")).count().collect()}


def prefix_and_pivots(word: str, counts) -> tuple[list[tuple[int, str, int]], tuple[int, int] | None]:
    """The prefix, (count, gram, place) in the global order, and the places of the two pivots.

    Words of two or three code points have no two disjoint bigrams, so no pivots."""
    grams = sorted((counts.get(_bucket(word[i:i + 2]), 0), word[i:i + 2], i) for i in range(len(word) - 1))
    if len(grams) < PREFIX:
        return grams, None
    last = grams[PREFIX - 1][1]
    prefix = [g for k, g in enumerate(grams) if k < PREFIX or g[1] == last]
    # best[k]: least total count of k disjoint grams among those seen so far, from left to right.
    best = [[(0, ())], [], []]
    for count, _, place in sorted(prefix, key=lambda g: g[2]):
        for k in (1, 0):
            ways = [(total + count, places + (place,)) for total, places in best[k] if not places or places[-1] + 2 <= place]
            best[k + 1] += [min(ways)] if ways else []
    return prefix, (min(best[2])[1] if best[2] else None)


def _letters(word: str) -> int:
    """A set of 63 letter classes as bits; one edit changes at most two."""
    bits = 0
    for c in word:
        bits |= 1 << ord(c) % 63
    return bits


def _side(mark: str, text: str, size: int) -> str:
    """The key of a common side in a word of ``size`` code points; long sides by their digest."""
    return f"{size}{mark}{text if len(text) <= 32 else hashlib.md5(text.encode()).hexdigest()}"


def _index(sent):
    """Rows of the index: a word's parts with their pivots (pivot true), for each length that a near
    word may have, and the beginnings and ends of a word that hold a prefix gram, for its length.

    A word has as many rows as code points, and more, so rows leave by volume."""

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), INDEX)], schema=INDEX)

    def run(batch):
        rows, volume, counts = [], 0, sent.value
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            prefix, pivots = prefix_and_pivots(word, counts)
            if pivots is None:
                continue
            rest = (word, n, f"{prefix[-1][0]:012d}{prefix[-1][1]}", _letters(word))
            size, places = len(word), [place for _, _, place in prefix]
            cut = min(max(size // 2, pivots[0] + 2), pivots[1])
            rows += [(_side("<", word[:cut], other), True, *rest) for other in (size - 1, size, size + 1)]
            rows += [(_side(">", word[cut:], other), True, *rest) for other in (size - 1, size, size + 1)]
            for cut in range(1, size):
                if cut >= min(places) + 2:
                    rows.append((_side("<", word[:cut], size), False, *rest))
                if cut <= max(places):
                    rows.append((_side(">", word[cut:], size), False, *rest))
                volume += 2 * size + 200
                if volume > FLUSH:
                    yield table(rows)
                    rows, volume = [], 0
        if rows:
            yield table(rows)

    return run


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of words one edit apart, in both directions.

    ``words``: (word, n) with distinct words of at least four code points."""
    sent = words.sparkSession.sparkContext.broadcast(gram_counts(words))
    rows = written(map_batches(words.select("word", "n"), _index(sent), "side string, pivot boolean, word string, n long, "
                               "last string, letters long"), "pivots")
    a, b = rows.filter("pivot").alias("a"), rows.filter("NOT pivot").alias("b")
    near = (F.col("a.last") <= F.col("b.last")) & (F.col("a.word") != F.col("b.word")) & (
        F.bit_count(F.col("a.letters").bitwiseXOR(F.col("b.letters"))) <= 2)
    found = (a.join(b, (F.col("a.side") == F.col("b.side")) & near)
             .filter(F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1))
    first = F.col("a.word") < F.col("b.word")
    one, two = F.struct("a.word", "a.n"), F.struct("b.word", "b.n")
    pairs = found.select(F.when(first, one).otherwise(two).alias("x"), F.when(first, two).otherwise(one).alias("y")).distinct()
    both = F.explode(F.array(F.struct(F.col("x").alias("p"), F.col("y").alias("q")),
                             F.struct(F.col("y").alias("p"), F.col("x").alias("q"))))
    return pairs.select(both.alias("b")).select(
        F.col("b.p.word").alias("word"), F.col("b.p.n").alias("n"),
        F.col("b.q.word").alias("near"), F.col("b.q.n").alias("near_n"))


def group_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct ``words`` (word, n).

    A word's form is its near word of largest n (ties: smallest in code-point order) if that is
    at least twice the word's n; root is the end of the chain of forms."""
    words = written(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= 2 * F.col("n")
    rows = written(words.join(near, "word", "left").select(
        "word", F.when(enough, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n")), "forms")
    # n doubles along a chain, so its length is at most log2(largest n); each round doubles the reach.
    most = rows.agg(F.max("n")).first()[0] or 1
    links = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(math.log2(most) + 2)))):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = written(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return (rows.join(links, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
