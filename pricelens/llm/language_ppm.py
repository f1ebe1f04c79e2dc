"""Language identification by prediction by partial matching (PPM).

Each language has a context tree over bytes: for every context of up to ``ORDER`` bytes the
counts of the bytes that followed it. A byte costs -log2 of its share in the longest context
in which it was seen, plus the escapes from the longer ones (method C: a context with total
count T and d distinct followers gives a byte of count c the share c / (T + d) and the escape
d / (T + d)); a byte never seen costs 8 bits. Statistics are frozen while a text is scored and
no exclusion is applied, so a text's code length is an exact sum over its bytes. The language
with the smallest code length, its share of the training documents included, is predicted.

A text is coded as its lower-cased words (runs of letters and marks), each closed by a space;
contexts begin with the space before the word. A word's code length then is the same wherever
it stands, so each distinct word of a batch is coded once, whole, and its length is added at
every place.

Scale: fitting counts the grams (context and byte) of all training rows: batches are counted
inside tasks and summed by one aggregation on (language, gram). No gram is dropped. Up to
``GRAMS`` of them are collected and broadcast, and scoring is one narrow pass. Of more, the code
lengths of the most frequent ones are broadcast (``GRAMS`` lengths in all languages together); a word
made of these only is coded in that pass, and the distinct others are coded by joins of their grams
with the tables of contexts and added to their texts. Both ways give the same code lengths.

Defined cases: null text, or text without a letter: ``und`` with score 0; a null doc_id counts
as the empty text in the held-out rule; rows without a language teach nothing; without any
training row every text is ``und``; of equally short codes the smallest language counts;
repeated rows each get their row. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import map_batches, split_batch, written

ORDER = 4  # longest context in bytes; a gram is a context and the byte after it
GRAMS = 1_000_000  # grams of the highest order that are broadcast; the others are joined
SLICE = 8 << 20  # bytes of text coded at a time
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
_SPACE = 32


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the index of each word in text order, and the texts' offsets into these."""
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL\pM]+")
    offsets = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), offsets - offsets[0]


def word_grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All grams of the words as integers of ORDER + 1 bytes, and the first gram of each word.

    A word of n bytes has n + 1 grams, the last one for the closing space; an empty word has
    one, of spaces only."""
    words = words.cast(pa.binary())
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    size = np.diff(ends)
    segment = size + ORDER + 1
    start = np.concatenate([[0], np.cumsum(segment)[:-1]])
    buf = np.full(int(segment.sum()), _SPACE, np.uint8)
    buf[np.arange(len(data)) + np.repeat(start + ORDER - (ends[:-1] - ends[0]), size)] = data
    wide = buf.astype(np.int64)
    gram = np.zeros(max(len(wide) - ORDER, 0), np.int64)
    for i in range(ORDER + 1):
        gram = (gram << 8) | wide[i:i + len(gram)]
    first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    at = np.arange(int((size + 1).sum())) + np.repeat(start - first, size + 1)
    return gram[at], first


def _count_batch(batch: pa.RecordBatch):
    """(lang, gram, n) of the batch; gram -1 counts the documents."""
    for part in split_batch(batch, "text", SLICE):
        langs = part.column("lang").dictionary_encode()
        names, which = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
        words, index, offsets = word_lists(part.column("text"))
        filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
        grams, first = word_grams(words)
        distinct, inverse = np.unique(grams, return_inverse=True)
        owner = np.repeat(np.arange(len(words)), np.diff(np.append(first, len(grams))))
        of_text = np.repeat(which, np.diff(offsets))
        for k, name in enumerate(names):
            times = np.bincount(index[of_text == k], minlength=len(words)) * filled
            n = np.bincount(inverse, weights=times[owner], minlength=len(distinct)).astype(np.int64)
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(seen) + 1), pa.string()), pa.array(np.append(distinct[seen], -1)),
                 pa.array(np.append(n[seen], int((which == k).sum())))], ["lang", "gram", "n"])


class Tree:
    """One language's contexts, an array of grams for each order with their code lengths."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.levels = []  # (order, grams, bits, contexts, bits of the escape)
        for order in range(ORDER, -1, -1):
            keys, where = np.unique(grams & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            count = np.bincount(where, weights=n)
            contexts, of = np.unique(keys >> 8, return_inverse=True)
            total = np.bincount(of, weights=count)
            followers = np.bincount(of)
            self.levels.append((order, keys, np.log2((total + followers)[of] / count), contexts,
                                np.log2((total + followers) / followers)))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        out = np.zeros(len(grams))
        todo = np.arange(len(grams))
        for order, keys, cost, contexts, escape in self.levels:
            key = grams[todo] & ((1 << 8 * (order + 1)) - 1)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            found = keys[at] == key
            out[todo[found]] += cost[at[found]]
            todo, context = todo[~found], key[~found] >> 8
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            out[todo] += np.where(contexts[at] == context, escape[at], 0.0)
        out[todo] += 8.0
        return out


def _least_power(sizes: list[tuple[int, int]], most: int) -> int:
    """The least t so that at most ``most`` grams are counted 2^t times or more; ``sizes``: (t, grams)."""
    kept, least = 0, 62
    for power, size in sorted(sizes, reverse=True):
        if kept + size > most:
            break
        kept, least = kept + size, power
    return least


def _sizes(counts: DataFrame, *by: str) -> DataFrame:
    return counts.groupBy(*by, F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count(F.lit(1)).alias("size"))


def fit(docs: DataFrame, grams: int = GRAMS) -> dict:
    """The languages of the training rows: {"langs": names, "prior": bits, "trees": arrays, "counts": table}.

    ``trees`` hold up to ``grams`` grams, shared evenly by the languages (of a language with more, those
    counted at least 2^t times, for the least t that fits). Where that is not all of them, ``counts``
    has (lang, gram, n) of every gram, for ``predict`` to take the others from; else it is None."""
    train = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = written(map_batches(train.select("text", F.col("lang").cast("string").alias("lang")), _count_batch,
                                 "lang string, gram long, n long")
                     .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    documents = {r["lang"]: r["n"] for r in counts.filter("gram = -1").collect()}  # one row a language
    counts = counts.filter("gram >= 0")
    sizes = {name: [] for name in documents}
    for r in _sizes(counts, "lang").collect():  # at most 64 rows a language
        sizes[r["lang"]].append((r["power"], r["size"]))
    langs = sorted(name for name in sizes if sizes[name])
    least = {name: _least_power(sizes[name], grams // max(len(documents), 1)) for name in langs}
    enough = [(F.col("lang") == name) & (F.col("n") >= 1 << power) for name, power in least.items()]
    found = {}
    if enough:
        keep = enough[0]
        for e in enough[1:]:
            keep = keep | e
        table = counts.filter(keep).toArrow()
        names = np.array(table["lang"].to_pylist(), object)
        for name in langs:
            mine = names == name
            found[name] = (table["gram"].to_numpy()[mine], table["n"].to_numpy()[mine])
    total = sum(documents[name] for name in langs)
    whole = all(len(found[name][0]) == sum(size for _, size in sizes[name]) for name in langs)
    return {"langs": langs, "prior": [float(np.log2(total / documents[name])) for name in langs],
            "trees": [found[name] for name in langs], "counts": None if whole else counts, "grams": grams}


def _orders(gram: Column) -> Column:
    """(order, key) of each context length: the gram's last ``order`` + 1 bytes."""
    return F.explode(F.array(*[F.struct(F.lit(k).alias("order"), gram.bitwiseAND((1 << 8 * (k + 1)) - 1).alias("key"))
                               for k in range(ORDER + 1)]))


def _costs(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, order, key, cost) of every byte seen in a context, (lang, order, context, escape) of every context."""
    context = F.shiftright("key", 8).alias("context")
    keys = (counts.select("lang", "n", _orders(F.col("gram")).alias("o")).groupBy("lang", "o.order", "o.key")
            .agg(F.sum("n").alias("n")).withColumn("context", context))
    contexts = keys.groupBy("lang", "order", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("followers"))
    contexts = written(contexts, "language-contexts")
    mass = F.col("total") + F.col("followers")
    costs = keys.join(contexts, ["lang", "order", "context"]).select("lang", "order", "key", F.log2(mass / F.col("n")).alias("cost"))
    escapes = contexts.select("lang", "order", "context", F.log2(mass / F.col("followers")).alias("escape"))
    return written(costs, "language-costs"), escapes


def _gram_bits(grams: DataFrame, costs: DataFrame, escapes: DataFrame, langs: list[str]) -> DataFrame:
    """(gram, bits): the code lengths of the distinct ``grams``, one for each language, as ``Tree.bits`` has them."""
    names = F.explode(F.array(*[F.lit(name) for name in langs])).alias("lang")
    asked = grams.select("gram", names).select("gram", "lang", _orders(F.col("gram")).alias("o")).select(
        "gram", "lang", "o.order", "o.key", F.shiftright("o.key", 8).alias("context"))
    asked = asked.join(costs, ["lang", "order", "key"], "left").join(escapes, ["lang", "order", "context"], "left")
    best = F.max(F.when(F.col("cost").isNotNull(), F.struct("order", "cost"))).alias("best")
    found = asked.groupBy("gram", "lang").agg(best, *[
        F.max(F.when(F.col("order") == k, F.col("escape"))).alias(f"escape{k}") for k in range(ORDER + 1)])
    bits = F.coalesce("best.cost", F.lit(8.0))
    for k in range(ORDER, -1, -1):
        passed = F.col("best").isNull() | (F.col("best.order") < k)
        bits = bits + F.when(passed, F.coalesce(f"escape{k}", F.lit(0.0))).otherwise(0.0)
    number = F.array_position(F.array(*[F.lit(name) for name in langs]), F.col("lang"))
    rows = found.groupBy("gram").agg(F.array_sort(F.collect_list(F.struct(number.alias("k"), bits.alias("bits")))).alias("rows"))
    return rows.select("gram", F.col("rows.bits").alias("bits"))


def _added(bits: str, times: str, langs: list[str]) -> Column:
    """The sums of the elements of ``bits``, each taken ``times`` times."""
    return F.array(*[F.sum(F.get(bits, F.lit(k)) * F.col(times)) for k in range(len(langs))]).alias("bits")


def code_lengths(texts: pa.Array, trees: list[Tree]) -> np.ndarray:
    """Bits of each text under each tree: an array of (texts, trees)."""
    words, index, offsets = word_lists(texts)
    grams, first = word_grams(words)
    distinct, inverse = np.unique(grams, return_inverse=True)
    filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    out = np.zeros((len(texts), len(trees)))
    for k, tree in enumerate(trees):
        word_bits = np.add.reduceat(tree.bits(distinct)[inverse], first) * filled
        sums = np.concatenate([[0.0], np.cumsum(word_bits[index])])
        out[:, k] = sums[offsets[1:]] - sums[offsets[:-1]]
    return out


def _decided(known: np.ndarray, bits: np.ndarray, langs: list[str], prior: list[float]) -> list[pa.Array]:
    """lang_pred, score and bits of texts from their code lengths."""
    if langs:
        total = bits + np.array(prior)
        best = total.argmin(axis=1)
        least = total.min(axis=1)
        score = 1 / np.exp2(np.clip(least[:, None] - total, -1000, 0)).sum(axis=1)
        names = [langs[b] if k else UNKNOWN for b, k in zip(best, known)]
        bits = bits[np.arange(len(best)), best]
    else:
        names, score, bits = [UNKNOWN] * len(known), np.zeros(len(known)), np.zeros(len(known))
    return [pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(np.where(known, bits, 0.0))]


def _has_letter(text: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_numpy(zero_copy_only=False)


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits): the language of each text, the probability
    of it that the code lengths give, and the code length in bits."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    keys = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean"
    if model["counts"] is not None:
        return _predict_joined(rows, model, keys)
    sent = docs.sparkSession.sparkContext.broadcast({k: model[k] for k in ("langs", "prior", "trees")})  # at most GRAMS grams
    trees: list[Tree] = []

    def run(batch):
        if not trees:
            trees.extend(Tree(*t) for t in sent.value["trees"])
        for part in split_batch(batch, "text", SLICE):
            text = part.column("text")
            bits = code_lengths(text, trees) if trees else np.zeros((len(text), 0))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"),
                 *_decided(_has_letter(text), bits, sent.value["langs"], sent.value["prior"])],
                ["doc_id", "held_out", "lang_pred", "score", "bits"])

    return map_batches(rows, run, f"{keys}, lang_pred string, score double, bits double")


def _predict_joined(rows: DataFrame, model: dict, keys: str) -> DataFrame:
    """``predict`` with a model of more grams than are broadcast. A text's row has the code lengths of its words
    that consist of broadcast grams, and the list of its other words, whose code lengths are joined."""
    langs, prior, counts = model["langs"], model["prior"], model["counts"]
    costs, escapes = _costs(counts)
    totals = counts.groupBy("gram").agg(F.sum("n").alias("n"))
    power = _least_power([(r["power"], r["size"]) for r in _sizes(totals).collect()], model["grams"] // len(langs))
    frequent = _gram_bits(totals.filter(F.col("n") >= 1 << power), costs, escapes, langs).orderBy("gram").toArrow()
    sent = rows.sparkSession.sparkContext.broadcast(
        (frequent["gram"].to_numpy(), np.array(frequent["bits"].combine_chunks().flatten()).reshape(-1, len(langs))))

    def run(batch):
        core, costs_of = sent.value
        for part in split_batch(batch, "text", SLICE):
            text = part.column("text")
            words, index, offsets = word_lists(text)
            grams, first = word_grams(words)
            distinct, inverse = np.unique(grams, return_inverse=True)
            at = np.minimum(np.searchsorted(core, distinct), max(len(core) - 1, 0))
            found = core[at] == distinct if len(core) else np.zeros(len(distinct), bool)
            filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
            coded = np.logical_and.reduceat(found[inverse], first) if len(first) else filled
            bits = np.zeros((len(text), len(langs)))
            for k in range(len(langs)):
                of_gram = np.where(found, costs_of[at, k], 0.0) if len(core) else np.zeros(len(distinct))
                sums = np.concatenate([[0.0], np.cumsum((np.add.reduceat(of_gram[inverse], first) * (filled & coded))[index])])
                bits[:, k] = sums[offsets[1:]] - sums[offsets[:-1]]
            rest = (filled & ~coded)[index]
            pairs, times = np.unique(np.repeat(np.arange(len(text)), np.diff(offsets))[rest] * len(words) + index[rest],
                                     return_counts=True)
            begins = np.searchsorted(pairs, np.arange(len(text) + 1) * len(words)).astype(np.int32)
            others = pa.StructArray.from_arrays([words.take(pa.array(pairs % max(len(words), 1))), pa.array(times.astype(np.int64))],
                                                ["word", "times"])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(_has_letter(text)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(text) + 1, dtype=np.int32) * len(langs)), pa.array(bits.ravel())),
                 pa.ListArray.from_arrays(pa.array(begins), others)], ["doc_id", "held_out", "known", "bits", "others"])

    texts = map_batches(rows, run, f"{keys}, known boolean, bits array<double>, others array<struct<word: string, times: long>>")
    texts = written(texts.withColumn("row", F.monotonically_increasing_id()), "language-lengths")
    others = texts.select("row", F.explode("others").alias("o")).select("row", "o.word", "o.times")

    def grams_of(batch):
        words = batch.column("word")
        grams, first = word_grams(words)
        pairs, times = np.unique(np.repeat(np.arange(len(words)), np.diff(np.append(first, len(grams)))) << 40 | grams,
                                 return_counts=True)
        yield pa.RecordBatch.from_arrays([words.take(pa.array(pairs >> 40)), pa.array(pairs & ((1 << 40) - 1)),
                                          pa.array(times.astype(np.int64))], ["word", "gram", "times"])

    grams = written(map_batches(others.select("word").distinct(), grams_of, "word string, gram long, times long"), "language-words")
    found = _gram_bits(grams.select("gram").distinct(), costs, escapes, langs)
    words = grams.join(found, "gram").groupBy("word").agg(_added("bits", "times", langs))
    more = others.join(words, "word").groupBy("row").agg(_added("bits", "times", langs)).withColumnRenamed("bits", "more")
    summed = texts.select("doc_id", "held_out", "known", "bits", "row").join(more, "row", "left").select(
        "doc_id", "held_out", "known",
        F.when(F.col("more").isNull(), F.col("bits")).otherwise(F.zip_with("bits", "more", lambda a, b: a + b)).alias("bits"))

    def decide(batch):
        bits = np.array(batch.column("bits").flatten()).reshape(-1, len(langs))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"),
             *_decided(batch.column("known").to_numpy(zero_copy_only=False), bits, langs, prior)],
            ["doc_id", "held_out", "lang_pred", "score", "bits"])

    return map_batches(summed, decide, f"{keys}, lang_pred string, score double, bits double")
