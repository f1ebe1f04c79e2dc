"""Variants of the public model, made by adding fields to its protobuf: parity with the sentencepiece library."""

import random

import pytest
import sentencepiece

from pricelens.llm import piece_tokenizer
from pricelens.llm.queries import TOKENIZER

# Later fields of a protobuf message override or extend earlier ones.
UNIGRAM = b"\x12\x02\x18\x01"      # trainer: model type 1
NO_BYTES = b"\x12\x03\x98\x02\x00"  # trainer: no byte fallback
TRIM = b"\x1a\x02\x20\x01"         # normaliser: remove extra spaces
NO_PREFIX = b"\x1a\x02\x18\x00"    # normaliser: no space in front
VARIANTS = {"bpe": b"", "bpe_trim": TRIM, "unigram": UNIGRAM, "unigram_trim": UNIGRAM + TRIM, "unigram_no_bytes": UNIGRAM + NO_BYTES,
            "unigram_trim_no_bytes": UNIGRAM + TRIM + NO_BYTES, "bpe_trim_no_bytes": TRIM + NO_BYTES, "bpe_no_prefix": NO_PREFIX}


def message(number, body):
    size, n = b"", len(body)
    while n > 127:
        size, n = size + bytes([n & 127 | 128]), n >> 7
    return bytes([number << 3 | 2]) + size + bytes([n]) + body


def variant(data, name):
    if "no_bytes" not in name:
        return data + VARIANTS[name]
    out = b""  # without fallback a model may hold no byte pieces: they become unused ones
    for number, value in piece_tokenizer.wire_fields(data):
        if number == 1 and (3, piece_tokenizer.BYTE) in list(piece_tokenizer.wire_fields(value)):
            value += bytes([3 << 3, piece_tokenizer.UNUSED])
        out += message(number, value)
    return out + VARIANTS[name]


def texts():
    rnd = random.Random(7)
    out = ["", " ", "\n", " \n ", "a \n b", " a\n b ", "a  \n  b", "\n a", "a \n", "  two  spaces  ", "tab \t x", "日本語 😀", "x" * 300]
    for alphabet in ("ab  \n-=.01é😀", "the and ing \n\n tion", "über  straße\r\n"):
        out += ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(120)]
    return out


@pytest.mark.parametrize("name", sorted(VARIANTS))
def test_parity_of_model_variants(spark, name):
    data = variant(piece_tokenizer.load_model(spark, TOKENIZER), name)
    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    model = piece_tokenizer.read_model(data)
    assert (model.kind == piece_tokenizer.UNIGRAM) == name.startswith("unigram") and model.trim_spaces == ("trim" in name)
    encoder = piece_tokenizer.Encoder(data, 1, True)
    for text, (ids, _, parity) in zip(texts(), encoder.encode(texts()), strict=True):
        want = sp.encode(text)
        got = [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)]
        assert got == want and parity, (name, text, sp.id_to_piece(got), sp.id_to_piece(want))
        if name.endswith("trim"):
            trimmed = " ".join(x for x in text.split(" ") if x)
            assert encoder.tok.decode(got, skip_special_tokens=False) == trimmed


def test_degenerate_tables(spark):
    data = piece_tokenizer.load_model(spark, TOKENIZER)
    rows = [(1, None, "x", 1), (2, "", "x", 2), (3, "a b", None, 3), (3, "a b", None, 3), (None, "a" * 50_000, "x", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 string, n_tokens int")
    got = piece_tokenizer.encode(df, data).collect()
    assert sorted((r.doc_id or 0, r.n_tokens > 0) for r in got) == [(0, True), (1, False), (2, False), (3, True), (3, True)]
    assert all(r.round_trip and r.parity for r in got)
    empty = piece_tokenizer.encode(df.limit(0), data)
    assert empty.count() == 0 and empty.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "round_trip", "parity"]
    assert piece_tokenizer.decode(empty, data).count() == 0
    for name in ("n_tokens", "ids_sha256"):
        with pytest.raises(ValueError):
            piece_tokenizer.encode(df, data, extra=("doc_id", name))
