"""SentencePiece encoding and decoding by the tokenizers library.

The model's protobuf is read field by field, and its normaliser, metaspace marker, piece
scores and byte fallback are rebuilt as a ``tokenizers`` pipeline: unigram models as a
Unigram with their scores, BPE models as merges ranked by the score of the merged piece.
Batches are encoded by the library's threads, decoded again to prove the round trip, and
compared with the sentencepiece library for parity.

Scale: a narrow pass, no shuffle. The model (``MAX_MODEL_BYTES`` at most, checked) travels
with the task; each task builds its tokenizer once and holds one slice of texts of about
``SLICE_BYTES`` at a time. No piece runs from a word into the next one's marker in most
vocabularies; where that is so, texts are cut before markers, which makes encoding linear.

Defined cases: a null text counts as empty; an empty text has no ids; control symbols'
strings in a text are ordinary text; repeated rows each get their row; very long texts are
encoded whole. ``extra`` columns are carried along unchanged.
"""

from __future__ import annotations

import hashlib
import os
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm.common import map_batches, split_batch

MAX_MODEL_BYTES = 64 << 20
SLICE_BYTES = 2 << 20
MAX_WORDS = 250_000  # words whose ids a task remembers from slice to slice: about 60 MB
JOINED = 4096
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format
UNIGRAM, BPE = 1, 2  # model types


# ---- the model file ----------------------------------------------------------------------


def wire_fields(data: bytes):
    """(field number, value) of a protobuf message; lengths as bytes, numbers as int, floats as 4 bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(kind)
        if n is None:
            if kind != 2:
                raise ValueError("not a SentencePiece model")
            n = varint()
        yield key >> 3, data[at: at + n]
        at += n


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # piece, score, type
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix_marker: bool = False
    unknown_surface: str = " ⁇ "
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True


def read_model(data: bytes) -> Model:
    """The parts of a SentencePiece model that decide how it encodes and decodes."""
    m = Model()
    for number, value in wire_fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in wire_fields(value):
                if n == 1:
                    piece = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            m.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in wire_fields(value):
                if n == 3:
                    m.kind = v
                elif n == 24:
                    m.suffix_marker = bool(v)
                elif n == 35:
                    m.byte_fallback = bool(v)
                elif n == 44:
                    m.unknown_surface = v.decode("utf-8")
        elif number == 3:
            for n, v in wire_fields(value):
                if n == 2:
                    m.charsmap = v
                elif n == 3:
                    m.dummy_prefix = bool(v)
                elif n == 4:
                    m.trim_spaces = bool(v)
                elif n == 5:
                    m.escape_spaces = bool(v)
    if m.kind not in (UNIGRAM, BPE) or m.suffix_marker or not m.escape_spaces:
        raise ValueError("only unigram and BPE models with a leading marker are supported")
    return m


def merges_of(model: Model) -> list[tuple[str, str]]:
    """All ways to make a piece of two pieces, best merged score first."""
    usable = {p for p, _, kind in model.pieces if kind == NORMAL}
    found = []
    for n, (piece, score, kind) in enumerate(model.pieces):
        if kind == NORMAL:
            for i in range(1, len(piece)):
                if piece[:i] in usable and piece[i:] in usable:
                    found.append((-score, n, i, piece))
    return [(p[:i], p[i:]) for _, _, i, p in sorted(found)]


def build_tokenizer(data: bytes):
    """A ``tokenizers.Tokenizer`` that encodes as the model does."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    m = read_model(data)
    unknown = next((i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN), 0)
    if m.kind == UNIGRAM:
        low = min((s for _, s, kind in m.pieces if kind == NORMAL), default=0.0)
        # Pieces that never match text get a score no path would choose.
        vocab = [(p, s if kind in (NORMAL, USER, UNKNOWN) else low - 1000.0) for p, s, kind in m.pieces]
        core = models.Unigram(vocab, unk_id=unknown, byte_fallback=m.byte_fallback)
    else:
        core = models.BPE(
            vocab={p: i for i, (p, _, _) in enumerate(m.pieces)}, merges=merges_of(m),
            unk_token=m.pieces[unknown][0], fuse_unk=True, byte_fallback=m.byte_fallback)
    tok = Tokenizer(core)
    steps = []
    if m.charsmap:
        steps.append(normalizers.Precompiled(m.charsmap))
    if m.trim_spaces:
        steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    tok.normalizer = normalizers.Sequence(steps)
    if not any(MARK in p.lstrip(MARK) for p, _, _ in m.pieces):
        tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if m.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tok.decoder = decoders.Sequence(back)
    user = [p for p, _, kind in m.pieces if kind == USER]
    if user:
        tok.add_tokens([AddedToken(p, normalized=False) for p in user])
    return tok


def expected_decoding(model: Model, text: str) -> str | None:
    """What decoding must give back; None where the normaliser rewrites characters."""
    if model.charsmap or not model.byte_fallback:
        return None
    return " ".join(x for x in text.split(" ") if x) if model.trim_spaces else text


def load_model(spark: SparkSession, path: str) -> bytes:
    """The model's bytes, read by the driver (a local path) or by Spark (any other store)."""
    if os.path.exists(path):
        with open(path, "rb") as f:
            data = f.read(MAX_MODEL_BYTES + 1)
    else:
        row = spark.read.format("binaryFile").load(path).select("length", "content").first()
        data = bytes(row["content"]) if row and row["length"] <= MAX_MODEL_BYTES else b""
    if not 0 < len(data) <= MAX_MODEL_BYTES:
        raise ValueError(f"no model of at most {MAX_MODEL_BYTES} bytes at {path}")
    return data


# ---- over a table ------------------------------------------------------------------------


class Encoder:
    """Encodes and verifies texts; remembers the ids of words.

    Where no piece crosses a marker, a text of words with single spaces between them encodes
    as its words do, one by one. Such texts are split, each distinct word of a slice is
    encoded once (joined to long texts again, so that the library encodes few long strings),
    and the ids are put together; the first ``MAX_WORDS`` words stay known to later slices.
    All other texts are encoded whole. Every text's ids are decoded whole: of split texts piece by
    piece, of the others by the library.
    """

    def __init__(self, data: bytes, threads: int, verify: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.tok, self.model, self.threads, self.sp = build_tokenizer(data), read_model(data), threads, None
        if verify:
            import sentencepiece

            self.sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        m = self.model
        self.marked = np.array([p.startswith(MARK) for p, _, _ in m.pieces])
        self.by_words = m.dummy_prefix and not m.charsmap and m.byte_fallback and not any(
            MARK in p.lstrip(MARK) or kind == USER for p, _, kind in m.pieces)
        self.bytes_of = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in m.pieces]
        self.words: dict[str, bytes] = {}
        self.bad_parity: set[str] = set()

    def whole(self, texts: list[str]) -> list[tuple[bytes, bool | None, bool | None]]:
        """(ids as little-endian 32-bit integers, round trip, parity) of each text."""
        ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        same = [None] * len(ids)
        if self.sp is not None:
            same = [a == b for a, b in zip(ids, self.sp.encode(texts, num_threads=self.threads), strict=True)]
        back = self.tok.decode_batch(ids, skip_special_tokens=False)
        wanted = [expected_decoding(self.model, t) for t in texts]
        return [(np.array(i, "<i4").tobytes(), None if w is None else w == d, p)
                for i, d, w, p in zip(ids, back, wanted, same, strict=True)]

    def learn(self, new: list[str]) -> None:
        """Encode distinct words, joined by spaces to texts of about JOINED words."""
        joined = [new[i: i + JOINED] for i in range(0, len(new), JOINED)]
        for words, (ids, trip, same) in zip(joined, self.whole([" ".join(w) for w in joined]), strict=True):
            i = np.frombuffer(ids, "<i4")
            starts = np.flatnonzero(self.marked[i])
            if len(starts) != len(words) or trip is False or same is False:
                for w, (one, _, p) in zip(words, self.whole(words), strict=True):  # find the words at fault
                    self.words[w] = one
                    if p is False:
                        self.bad_parity.add(w)
                continue
            edges = (4 * np.r_[starts, len(i)]).tolist()
            self.words.update(zip(words, (ids[x:y] for x, y in zip(edges[:-1], edges[1:], strict=True)), strict=True))

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool | None, bool | None]]:
        out: list = [None] * len(texts)
        split: dict[int, list[str]] = {}
        rest = []
        for n, t in enumerate(texts):
            if self.by_words and t and t[0] != " " and t[-1] != " " and "  " not in t and MARK not in t:
                split[n] = t.split(" ")
            else:
                rest.append(n)
        new = {w for words in split.values() for w in words if w not in self.words}
        self.learn(list(new))
        known = self.words
        for n, words in split.items():
            ids = b"".join([known[w] for w in words])
            back = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<i4").tolist()))
            out[n] = (ids, back == b" " + texts[n].encode(),  # the space put in front
                      None if self.sp is None else not self.bad_parity or self.bad_parity.isdisjoint(words))
        if len(known) > MAX_WORDS:  # the frequent words came first; forget this slice's
            for w in new:
                del known[w]
            self.bad_parity -= new
        for n, found in zip(rest, self.whole([texts[n] for n in rest]), strict=True):
            out[n] = found
        return out


ADDED = "ids array<int>, n_tokens long, ids_sha256 string, round_trip boolean, parity boolean"


def encode(docs: DataFrame, model: bytes, text: str = "text", extra: tuple[str, ...] = ("doc_id",), threads: int = 2,
           verify: bool = True, with_ids: bool = True) -> DataFrame:
    """``extra`` columns with ids, n_tokens, ids_sha256, round_trip and parity of every row's whole text.

    ``ids_sha256`` digests the ids as little-endian 32-bit integers. ``round_trip``: the
    decoded ids are the text that the normaliser leaves (null if it rewrites characters).
    ``parity``: the sentencepiece library gives the same ids (null without ``verify``); for texts
    that are split into words it is a check of words: it holds if it holds for each word.
    Names of ``extra`` that clash with the added columns are refused.
    """
    added = [c.split()[0] for c in ADDED.split(", ") if with_ids or not c.startswith("ids ")]
    if clash := set(extra) & {*added, "__text"}:
        raise ValueError(f"columns {sorted(clash)} clash with the result's")
    source = docs.select(*extra, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    schema += ", " + (ADDED if with_ids else ADDED.split(", ", 1)[1])
    n = len(extra)

    def rows(batches):
        encoder = Encoder(model, threads, verify)
        for batch in batches:
            for part in split_batch(batch, "__text", SLICE_BYTES):
                found = encoder.encode(part.column(n).to_pylist())
                ids = [f[0] for f in found]
                arrays = [part.column(i) for i in range(n)]
                if with_ids:
                    offsets = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(ids), "<i4"))))
                arrays += [
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([f[1] for f in found], pa.bool_()), pa.array([f[2] for f in found], pa.bool_())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*extra, *added])

    return source.mapInArrow(rows, schema)


def decode(encoded: DataFrame, model: bytes, ids: str = "ids", extra: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``extra`` columns with ``text``, the decoded ids; null ids give a null text."""
    source = encoded.select(*extra, F.col(ids).cast("array<int>").alias("__ids"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]) + ", text string"
    n = len(extra)

    def rows(batches):
        tok = build_tokenizer(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                lists = part.column(n).to_pylist()
                texts = [None if i is None else tok.decode(i, skip_special_tokens=False) for i in lists]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(n)), pa.array(texts, pa.string())], names=[*extra, "text"])

    return source.mapInArrow(rows, schema)
