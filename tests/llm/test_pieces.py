import hashlib
import os
import struct

import numpy as np
import pytest

from millrace.llm import pieces
from millrace.llm.queries import model_bytes

ODD = [
    "", " ", "  two  blanks ", "tab\there\n\nnew", "日本語 ▁ literal ▁▁x", "emoji 😀😀", "<s> hi </s> <0x0A>", "\x00a", "a b",
    "trail  ", "ＷＩＤＥ ﬁ", "é", " ", "▁", "▁▁ a",
]


def sentencepiece(message):
    import sentencepiece as library

    return library.SentencePieceProcessor(model_proto=message)


def test_ids_equal_those_of_the_library(frame, corpus):
    rows = corpus + [(1000 + k, t) for k, t in enumerate(ODD)]
    found = pieces.encoded(frame(rows), model_bytes()).collect()
    theirs = sentencepiece(model_bytes())
    wanted = [theirs.encode(t or "") for _, t in rows]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, list(r.ids), r.ids_sha256) for r in found)
    assert got == sorted(
        (str(i), len((t or "").encode()), len(w), w, hashlib.sha256(np.array(w, "<i4").tobytes()).hexdigest()) for (i, t), w in zip(rows, wanted)
    )
    assert all(r.parity and r.round_trip for r in found)


def test_ids_decode_to_the_texts(spark, frame, corpus):
    rows = [(i, t) for i, t in corpus if i and "▁" not in (t or "")]
    ids = pieces.encoded(frame(rows), model_bytes(), parity_of=1000)
    back = {r.doc_id: r.text for r in pieces.decoded(ids, model_bytes()).collect()}
    assert back == {i: t or "" for i, t in rows}
    assert [r.text for r in pieces.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), model_bytes()).collect()] == [None]


def test_parity_is_asked_for_a_share(frame, corpus):
    found = pieces.encoded(frame(corpus), model_bytes(), parity_of=4, with_ids=False)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "ids_sha256", "round_trip", "parity"]
    asked = [r.parity for r in found.collect()]
    assert None in asked and True in asked and False not in asked


def test_the_query_and_the_pipeline_compare_every_text(spark):
    import corpus_pipeline
    from millrace.llm import queries

    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    docs = queries.table(spark, folder, "documents")
    for found in (queries.encoded(spark, folder), corpus_pipeline.encoded(spark, docs, folder)):
        assert found.count() == docs.count() and found.where("parity").count() == docs.count()


def test_empty_table(frame):
    assert pieces.encoded(frame([]), model_bytes()).count() == 0


def test_units_are_forgotten_when_there_are_many(monkeypatch):
    import pyarrow as pa

    codec = pieces.Codec(model_bytes())
    monkeypatch.setattr(codec, "KEPT", 5)
    theirs = sentencepiece(model_bytes())
    for text in ("one two three", "four five six seven eight nine ten", "one two"):
        offsets, ids, back = codec.encode(pa.array([text, None, text]))
        assert ids[: offsets[1]].tolist() == theirs.encode(text) and back == [text.encode(), b"", text.encode()]


def field(number, value):
    def varint(x):
        out = b""
        while x > 0x7F:
            out, x = out + bytes([x & 0x7F | 0x80]), x >> 7
        return out + bytes([x])

    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def model(kind, listed, prefix=1, squeeze=1, fallback=1):
    """A model file written by hand."""
    special = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256) if fallback]
    out = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, t)) for p, s, t in special + listed)
    out += field(2, field(3, kind) + field(35, fallback) + field(40, 0))
    return out + field(3, field(1, b"identity") + field(3, prefix) + field(4, squeeze) + field(5, 1))


UNIGRAM = [("▁", -2.0, 1), ("▁the", -1.5, 1), ("the", -3.0, 1), ("▁ca", -3.1, 1), ("t", -4.0, 1), ("h", -4.1, 1), ("e", -4.2, 1), ("cat", -2.5, 1), ("c", -4.5, 1), ("a", -4.4, 1)]
BPE = [("▁", -20.0, 1), ("a", -21.0, 1), ("b", -22.0, 1), ("c", -23.0, 1), ("ab", -1.0, 1), ("▁a", -2.0, 1), ("bc", -3.0, 1), ("abc", -4.0, 1), ("c▁", -5.0, 1), ("c▁a", -6.0, 1)]


@pytest.mark.parametrize("kind, listed", [(1, UNIGRAM), (2, BPE)])
@pytest.mark.parametrize("prefix", [0, 1])
@pytest.mark.parametrize("squeeze", [0, 1])
def test_rebuilt_models_of_both_kinds(frame, kind, listed, prefix, squeeze):
    message = model(kind, listed, prefix, squeeze)
    some = ["the cat", "thecat  at the", " abc abcab c ab", "x\nabc", "", "é cat", "abc  abc", "cab "]
    pieces.probe(message, some)
    found = pieces.encoded(frame(list(enumerate(some))), message).collect()
    assert all(r.parity and r.round_trip for r in found)


def test_a_differing_model_is_told():
    other = pieces.Codec.encode
    try:
        pieces.Codec.encode = lambda self, column: (lambda o, i, b: (o, i + 1, b))(*other(self, column))
        with pytest.raises(ValueError):
            pieces.probe(model_bytes(), ["a text"])
    finally:
        pieces.Codec.encode = other


def test_files_that_are_no_models():
    for message in (b"", b"\xff\xff", field(9, 1), b"\x0a\x7fabc"):
        with pytest.raises((ValueError, IndexError)):
            pieces.parse(message)
    with pytest.raises(ValueError):
        pieces.build(pieces.parse(model(3, BPE)))
