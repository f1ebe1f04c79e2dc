"""Repeated-substring removal over the corpus: every byte that an earlier equal string covers.

A window is a string of ``length`` bytes inside one document. A window is *repeated* if an
equal window starts earlier, in a document of smaller doc_id or earlier in the same one.
Bytes covered by repeated windows are removed; windows are judged on the input.

Method. Suffix sorting by difference covers samples positions so that any two suffixes meet
in a sample within a fixed distance, names the samples by sorting, and orders all other
suffixes by their distance to a named sample. Here every comparison ends after ``length``
bytes, so the cover can be chosen by content: the position of the smallest hash of a
``gram``-byte string in each window (a local, hence consistent, choice; a string
synchronising set). Equal windows sample the same place in themselves, so *all* equal
windows meet in their sample, without the residue classes that make a positional cover
emit 12 % of all positions and more; this one samples about 2.8 %.

1. Samples. Each sample covers a run of consecutive windows. It is named by the hash of its
   ``gram`` bytes (key) and of the whole context its windows span (class).
2. Names. Samples of one class have equal windows throughout, so all but the earliest are
   repeated. This is settled inside each Arrow batch first (pre-aggregation: a class crosses
   the shuffle once per batch), then by one sort on (key, class, position).
3. Recursion. Where one key has several classes, the earliest samples of the classes are
   renamed by a longer core: the windows that reach far to the left of the sample share the
   bytes before it, the others those after it. Chance repetitions of short grams end here.
   Where a core still has several classes (the borders of shared passages), the windows
   are named singly, by 128-bit hashes, and sorted; adjacent equal names are repeats.
4. Repeated windows return to their documents as runs, and the runs are cut out.

Every stage is a shuffle by hash with bounded rows; a document's runs meet only that
document. Nothing is collected.

Defined cases: a null text counts as empty; texts shorter than ``length`` bytes lose
nothing; rows with a null doc_id come after all others; rows sharing a doc_id count as
texts of one document laid on top of each other: an equal window at a smaller start is
earlier, one at the same start is not, so an exact repetition of a row changes neither row's
result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import map_batches, written

LENGTH, GRAM = 100, 30
SLAB = 4 << 20  # bytes hashed together; a longer document is a slab of its own
BASE = 0x9E3779B97F4A7C15  # an odd multiplier
MIX = 0xD6E8FEB86659FD93
LAST_ID = (1 << 63) - 1  # stands for a null doc_id in comparisons
POSITION_BITS = 24
# A run of windows is packed as start << 16 | (sample's distance from start) << 8 | count.
START_BITS, SAMPLE_BITS, LOW = 16, 8, 255


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(MIX)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(BASE)
    return h ^ (h >> np.uint64(32))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each string of ``gram`` bytes: Horner's rule by doubling, mixed at the end."""
    done, size = None, 0  # hash of the first `size` bytes of each string
    power, width = data.astype(np.uint64) + np.uint64(1), 1
    factor = BASE
    left = gram
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                if done is None:
                    done, size = power, width
                else:
                    n = len(data) - size - width + 1
                    done = done[:n] * np.uint64(pow(BASE, width, 1 << 64)) + power[size: size + n]
                    size += width
            left >>= 1
            if left:
                n = len(power) - width
                power = power[:n] * np.uint64(factor) + power[width: width + n]
                width *= 2
                factor = factor * factor % (1 << 64)
        return _mixed(done[: len(data) - gram + 1])


def sliding_first_min(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of each ``width`` consecutive values (at most 2**24 values)."""
    low = np.uint64((1 << POSITION_BITS) - 1)
    best = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if size < width:
        best = np.minimum(best[: len(best) - (width - size)], best[width - size:])
    return (best & low).astype(np.int64)


def samples(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Runs of windows by their sample, over documents laid end to end.

    Returns (doc number, first window, number of windows, sample's place, hash of the
    sampled gram); all windows of a run hold its sample, so a count stays below 256.
    """
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, np.empty(0, np.uint64)
    h = gram_hashes(data, gram)
    anchor = _anchors(h, length - gram + 1)
    doc = np.repeat(np.arange(len(starts)), ends - starts)[: len(anchor)]
    ok = np.arange(len(anchor)) + length <= ends[doc]
    at = np.flatnonzero(ok)
    if not len(at):
        return empty, empty, empty, empty, np.empty(0, np.uint64)
    a, d = anchor[at], doc[at]
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])])
    count = np.diff(np.r_[new, len(at)])
    return d[new], at[new], count, a[new], h[a[new]]


def _anchors(h: np.ndarray, width: int) -> np.ndarray:
    limit = 1 << POSITION_BITS
    if len(h) <= limit:
        return sliding_first_min(h, width)
    step = limit - width + 1  # a very long document: overlapping pieces give the same minima
    return np.concatenate([sliding_first_min(h[i: i + limit], width) + i
                           for i in range(0, len(h) - width + 1, step)])


def _texts(column: pa.Array) -> list[bytes]:
    return [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in column]


def _slabs(texts: list[bytes]):
    """(first, last) of consecutive texts of about SLAB bytes together."""
    first = total = 0
    for i, t in enumerate(texts):
        if i > first and total + len(t) > SLAB:
            yield first, i
            first, total = i, 0
        total += len(t)
    if len(texts) > first:
        yield first, len(texts)


CANDIDATE, REPEATED, BORDER = 0, 1, 2
ROWS = "key long, cls long, id long, tag int, run long, kind int"


def _packed(start, sample, count):
    return start << START_BITS | sample << SAMPLE_BITS | count


def _rows(key, cls, ids, tag, run, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(key.view(np.int64)), pa.array(cls.view(np.int64)), pa.array(ids), pa.array(tag),
        pa.array(run), pa.array(kind)], names=["key", "cls", "id", "tag", "run", "kind"])


def _named_in_batch(key, cls, ids, tag, run) -> pa.RecordBatch:
    """Settle what one batch can: of equal names all but the earliest are repeated already."""
    order = np.lexsort((run, ids, cls, key))
    key, cls, ids, tag, run = (x[order] for x in (key, cls, ids, tag, run))
    kind, _ = _status(key, cls, ids, run, None)
    kind = np.where(kind == REPEATED, REPEATED, CANDIDATE).astype(np.int32)
    return _rows(key, cls, ids, tag, run, kind)


def _status(key, cls, ids, run, before):
    """REPEATED where an earlier row has the same name, else CANDIDATE; rows sorted by name and place.

    ``before`` is (key, cls, id, run) of the first row of the name under way, from an
    earlier batch; the same tuple for the last name here is returned.
    """
    new = np.r_[True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])]
    first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    first_id, first_run = ids[first], run[first]
    if before is not None and before[0] == key[0] and before[1] == cls[0]:
        going = first == 0
        first_id, first_run = first_id.copy(), first_run.copy()
        first_id[going], first_run[going] = before[2], before[3]
    later = (ids != first_id) | (run >> START_BITS != first_run >> START_BITS)
    kind = np.where(later, REPEATED, CANDIDATE).astype(np.int32)
    return kind, (key[-1], cls[-1], first_id[-1], first_run[-1])


def sample_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Sampled runs of windows: key, class, document, run; REPEATED ones are settled."""

    def run(batch: pa.RecordBatch):
        ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = _texts(batch.column(2))
        found = []
        for lo, hi in _slabs(texts):
            blob = b"".join(texts[lo:hi])
            ends = np.cumsum([len(t) for t in texts[lo:hi]])
            starts = np.r_[0, ends[:-1]]
            d, first, count, place, key = samples(np.frombuffer(blob, np.uint8), starts, ends, length, gram)
            stop = (first + count - 1 + length).tolist()
            cls = np.array([xxhash.xxh3_64_intdigest(blob[s:e]) for s, e in zip(first.tolist(), stop, strict=True)],
                           dtype=np.uint64)
            found.append((key, cls, ids[lo + d], tags[lo + d], _packed(first - starts[d], place - first, count)))
        key, cls, i, t, r = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(key):
            yield _named_in_batch(key, cls, i, t, r)

    return map_batches(docs.select("id", "tag", "text"), run, ROWS)


def settled(rows: DataFrame, borders: bool) -> DataFrame:
    """(id, tag, run, kind) of REPEATED runs and, with ``borders``, of the BORDER runs.

    One sort by (key, class, place). A BORDER is the earliest run of its class where the
    key has several classes. Rows settled before ride along under a spread key.
    """
    spread = F.when(F.col("kind") == REPEATED, F.xxhash64("id", "run")).otherwise(F.col("key"))
    dealt = rows.repartition(spread).sortWithinPartitions("kind", "key", "cls", "id", "run")
    names = ["id", "tag", "run", "kind"]

    def run(batches):
        before = held = None  # held: the first class's first row of a key that has shown one class so far
        for batch in batches:
            if not batch.num_rows:
                continue
            key, cls, ids, tag, runs, kind = (batch.column(i).to_numpy() for i in range(6))
            done = kind == REPEATED  # sorted to the end of the partition
            if done.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[done]) for x in (ids, tag, runs, kind)], names=names)
                key, cls, ids, tag, runs = (x[~done] for x in (key, cls, ids, tag, runs))
            if not len(key):
                continue
            previous = before
            status, before = _status(key, cls, ids, runs, before)
            out = status == REPEATED
            parts = [[x[out] for x in (ids, tag, runs, status)]]
            if borders:
                new_cls = np.r_[previous is None or previous[0] != key[0] or previous[1] != cls[0],
                                (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])]
                at = np.flatnonzero(new_cls)  # earliest rows of the classes that begin here
                k = key[at]
                if held is not None:
                    at_key = np.r_[held[0], k]
                else:
                    at_key = k
                same_before = np.r_[False, at_key[1:] == at_key[:-1]]
                same_after = np.r_[at_key[1:] == at_key[:-1], False]
                several = same_before | same_after
                if held is not None:
                    # The held class is a border once its key shows another; if it was one already, it is out.
                    if len(several) > 1 and several[0] and not held[2]:
                        parts.append([np.array([v]) for v in held[1]])
                    own = several[1:].copy()
                    if held[2] and len(k):
                        own |= k == held[0]
                else:
                    own = several
                if len(at):
                    take = at[own]
                    parts.append([ids[take], tag[take], runs[take], np.full(len(take), BORDER, np.int32)])
                    last = at[-1]
                    held = (key[last], (ids[last], tag[last], runs[last], np.int32(BORDER)), bool(own[-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=names)

    return dealt.mapInArrow(run, "id long, tag int, run long, kind int")


def _by_document(runs: DataFrame) -> DataFrame:
    """One row per document with the list of its runs (at most one for each of its windows)."""
    return runs.groupBy(F.col("id").alias("r_id"), F.col("tag").alias("r_tag")).agg(F.collect_list("run").alias("runs"))


def _with_runs(docs: DataFrame, runs: DataFrame, how: str) -> DataFrame:
    """Documents with the list of their runs. All uses take the same columns, so the texts are shuffled once."""
    listed = _by_document(runs).hint("shuffle_hash")
    return docs.join(listed, (F.col("id") == F.col("r_id")) & (F.col("tag") == F.col("r_tag")), how)


def core_rows(docs: DataFrame, borders: DataFrame, length: int, gram: int) -> DataFrame:
    """BORDER runs renamed by longer cores: windows starting far before the sample, and the others."""
    reach = (length - gram + 1) // 2  # windows starting this far before the sample hold that many bytes before it

    def run(batch: pa.RecordBatch):
        key, cls, row, out = [], [], [], []
        name = xxhash.xxh3_64_intdigest
        for n, (text, runs) in enumerate(zip(_texts(batch.column(2)), batch.column(3), strict=True)):
            for r in runs.values.to_pylist():
                start, sample, count = r >> START_BITS, r >> SAMPLE_BITS & LOW, r & LOW
                at = start + sample
                turn = min(max(at - reach + 1, start), start + count)  # first window that starts near the sample
                for lo, hi, a, z in ((start, turn, at - reach, at + gram), (turn, start + count, at, at + length - reach + 1)):
                    if lo < hi:
                        key.append(name(text[a:z], 1 + (a == at)))
                        cls.append(name(text[lo: hi - 1 + length]))
                        row.append(n)
                        out.append(_packed(lo, at - lo, hi - lo) if at >= lo else _packed(lo, 0, hi - lo))
        at = np.array(row, np.int64)
        yield _named_in_batch(np.array(key, np.uint64), np.array(cls, np.uint64), batch.column(0).to_numpy()[at],
                              batch.column(1).to_numpy()[at], np.array(out, np.int64))

    source = _with_runs(docs, borders, "inner").select("id", "tag", "text", "runs", "doc_id")
    return map_batches(source, run, ROWS)


def window_rows(docs: DataFrame, borders: DataFrame, length: int) -> DataFrame:
    """The single windows of BORDER runs, named by a 128-bit hash."""

    def run(batch: pa.RecordBatch):
        found = []
        texts = _texts(batch.column(2))
        for n, (text, runs) in enumerate(zip(texts, batch.column(3), strict=True)):
            r = runs.values.to_numpy()
            first, count = r >> START_BITS, r & LOW
            at = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = np.unique(at)
            names = b"".join(xxhash.xxh3_128_digest(text[p: p + length]) for p in at.tolist())
            found.append((np.frombuffer(names, np.uint64).reshape(-1, 2), np.full(len(at), n), at))
        name, n, at = (np.concatenate(x) for x in zip(*found, strict=True))
        ids, tags = batch.column(0).to_numpy()[n], batch.column(1).to_numpy()[n]
        yield _named_in_batch(np.ascontiguousarray(name[:, 0]), np.ascontiguousarray(name[:, 1]), ids, tags,
                              _packed(at, 0, 1))

    source = _with_runs(docs, borders, "inner").select("id", "tag", "text", "runs", "doc_id")
    return map_batches(source, run, ROWS)


def cut(text: bytes, runs: np.ndarray, length: int) -> tuple[bytes, int, int]:
    """(what remains, bytes removed, maximal removed spans) after cutting the windows of ``runs``."""
    if not len(runs):
        return text, 0, 0
    edge = np.zeros(len(text) + 1, np.int64)
    first, count = runs >> START_BITS, runs & LOW
    np.add.at(edge, first, 1)
    np.add.at(edge, first + count - 1 + length, -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
    left = np.frombuffer(text, np.uint8)[~gone].tobytes()
    return left, int(gone.sum()), spans


def keyed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, id (never null), tag (tells rows of one doc_id apart by text), text as bytes.

    Tags are needed only in a table that has repeated doc_ids; elsewhere all are 0 and
    weigh nothing in a compressed shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    repeated = docs.groupBy(number.alias("id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    tag = F.coalesce(F.pmod(F.hash(text), F.lit(1 if repeated.isEmpty() else (1 << 31) - 1)), F.lit(0))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("id"), tag.alias("tag"),
                       text.cast("binary").alias("text"))


def repeated_runs(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, tag, run): the repeated windows of every document, packed as runs."""

    def of(settled_rows: DataFrame, kind: int) -> DataFrame:
        return settled_rows.filter(F.col("kind") == kind).select("id", "tag", "run")

    first = written(settled(sample_rows(keyed, length, gram), borders=True), "repeats")
    second = settled(core_rows(keyed, of(first, BORDER), length, gram), borders=True)
    third = settled(window_rows(keyed, of(second, BORDER), length), borders=False)
    return of(first, REPEATED).unionByName(of(second, REPEATED)).unionByName(of(third, REPEATED))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes)."""
    if not 1 <= gram < length or length - gram + 1 > LOW:
        raise ValueError("gram must be below length, by less than 255")
    keyed = keyed_documents(docs)
    source = _with_runs(keyed, repeated_runs(keyed, length, gram), "left").select("doc_id", "text", "runs")

    def run(batch: pa.RecordBatch):
        texts, none = _texts(batch.column(1)), np.empty(0, np.int64)
        out = [cut(t, r.values.to_numpy() if r.is_valid else none, length)
               for t, r in zip(texts, batch.column(2), strict=True)]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()),
            pa.array([hashlib.sha256(o[0]).hexdigest() for o in out], pa.string()),
            pa.array([o[0] for o in out], pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return map_batches(
        source, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
