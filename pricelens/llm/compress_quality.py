"""Quality scores from compression with dictionaries of good and bad text.

Two zstandard dictionaries are built from labelled text, one of good and one of bad
documents. A text is compressed with both, in chunks of ``CHUNK`` bytes (so that a long text
does not turn into its own dictionary); the difference of the two sizes, normalised by their
sum and by the text's length, is calibrated to a probability by logistic regression on
labelled documents that went into neither dictionary.

Scale: fitting reads a bounded sample: ``SAMPLE`` labelled rows of each class, of which
half give ``WINDOW`` bytes each to the dictionaries and half give four numbers each to the
calibration. The sample's ids are broadcast (bounded); scoring is one narrow pass over whole
texts with two dictionaries of ``DICTIONARY`` bytes, no shuffle.

Defined cases: a null text counts as empty; an empty text gets the calibrated score of its
zero features; without labelled rows of one class all rows get the share of label 1 (1.0
without any labels); a null doc_id is held out; repeated rows each get their row; of
several labels for a document the smallest counts. Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import map_batches
from pricelens.llm.labelled import apply_logistic, fit_logistic, remainder, sample_labels, training_labels

SAMPLE = 6000  # labelled rows of each class, at most
WINDOW = 4096  # bytes of each sampled text that may go into a dictionary
DICTIONARY = 112_640
CHUNK = 2048
LEVEL = 3


def train(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary of the samples; raw content where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


class Sizer:
    """Compressed sizes of a text under the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.two = [self._compressor(d) for d in (good, bad)]

    @staticmethod
    def _compressor(data: bytes):
        d = zstandard.ZstdCompressionDict(data)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            dict_data=d, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False)

    def __call__(self, text: bytes) -> tuple[int, int, int]:
        good, bad = self.two
        g = b = 0
        for i in range(0, len(text), CHUNK):
            part = text[i: i + CHUNK]
            g += len(good.compress(part))
            b += len(bad.compress(part))
        return len(text), g, b


def features(sizes: np.ndarray) -> np.ndarray:
    """Of (length, good size, bad size): the normalised differences, the ratio, and their squares."""
    n, g, b = (np.maximum(sizes[:, i].astype(float), 1.0) for i in range(3))
    by_size, by_length = (b - g) / (b + g), (b - g) / n
    ratio = np.log(np.minimum((g + b) / (2 * n), 4.0))
    long = np.log(np.minimum(n, 2.0 * CHUNK))
    return np.stack([by_size, by_length, ratio, long, by_size ** 2, ratio ** 2, by_size * ratio, ratio * long,
                     by_size * long, np.minimum(ratio, -1.5), np.minimum(ratio, -2.5)], axis=1)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, y, text) of the sampled documents, one row each: the sample (bounded) is broadcast.

    Of rows that share a doc_id the smallest text counts; they are reduced before the shuffle.
    """
    return docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")).join(
        F.broadcast(sample), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> dict:
    """Dictionaries and calibration, or a constant score where a class has no labelled text."""
    ids, counts = sample_labels(training_labels(labels, label), {0: sample, 1: sample})
    total = sum(counts.values())
    constant = {"constant": counts[1] / total if total else 1.0}
    if not all(counts.values()):
        return constant
    rows = sampled_texts(docs, ids)
    half = F.xxhash64(F.lit("half"), "doc_id") % 2 == 0
    # A window at a place that the doc_id's hash picks, of each text of the dictionaries' half.
    start = F.pmod(F.xxhash64(F.lit("start"), "doc_id"), F.greatest(F.length("text") - WINDOW + 1, F.lit(1))).cast("int")
    windows = rows.filter(half).select("doc_id", "y", F.substring(F.col("text"), start + 1, F.lit(WINDOW)).alias("w"))
    got = sorted(windows.collect(), key=lambda r: r["doc_id"])  # at most 2 * SAMPLE windows
    parts = {y: [bytes(r["w"]) for r in got if r["y"] == y and r["w"]] for y in (0, 1)}
    if not all(parts.values()):
        return constant
    good, bad = train(parts[1]), train(parts[0])

    def sizes(batch: pa.RecordBatch):
        sizer = Sizer(good, bad)
        found = np.array([sizer(t.as_buffer().to_pybytes()) for t in batch.column(1)], np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(found[:, i]) for i in range(3))], names=["y", "n", "g", "b"])

    rest = map_batches(rows.filter(~half).select("y", "text"), sizes, "y int, n long, g long, b long").collect()
    data = np.array([tuple(r) for r in rest], np.int64).reshape(-1, 4)  # four numbers of at most 2 * SAMPLE rows
    if len(set(data[:, 0].tolist())) < 2:
        return constant
    y = data[:, 0]
    weight = np.where(y == 1, counts[1] / max((y == 1).sum(), 1), counts[0] / max((y == 0).sum(), 1))
    return {"good": good, "bad": bad,
            "logistic": fit_logistic(features(data[:, 1:]), y.astype(float), weight * len(y) / weight.sum())}


def score(docs: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per document."""
    if "constant" in model:
        scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(model["constant"]).alias("score"))
    else:
        packed = zlib.compress(model["good"]), zlib.compress(model["bad"])

        def run(batches):
            sizer = Sizer(*map(zlib.decompress, packed))
            for batch in batches:
                if batch.num_rows:
                    found = np.array(
                        [sizer(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(1)], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.array(apply_logistic(model["logistic"], features(found)))],
                        names=["doc_id", "score"])

        scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
                             ).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows scored below the threshold, all columns as they are; a narrow pass."""
    if "constant" in model:
        return docs if model["constant"] >= threshold else docs.limit(0)
    packed = zlib.compress(model["good"]), zlib.compress(model["bad"])
    at = docs.columns.index("text")

    def run(batches):
        sizer = Sizer(*map(zlib.decompress, packed))
        for batch in batches:
            if batch.num_rows:
                texts = batch.column(at)
                found = np.array([sizer((t.as_py() or "").encode("utf-8")) for t in texts], np.int64)
                good = apply_logistic(model["logistic"], features(found)) >= threshold
                yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
