"""SentencePiece models on the tokenizers library.

The model file (a protobuf message) is parsed here and rebuilt: its normaliser, the marker for blanks,
its pieces with their scores (a unigram model) or the merges that the scores imply (a BPE model), and
byte fallback. Batches are encoded on several threads of the task. The rebuilt tokenizer is compared
with the sentencepiece library.

Control pieces in a text are ordinary text. Nulls: a null text has no ids and decodes to the empty
text. Very long texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from millrace.llm import texts
from millrace.llm.rows import quoted

#: Threads that a task encodes a batch with; more would take cores that other tasks have.
THREADS = 2

#: Marks blanks in pieces.
MARK = "▁"

#: Fixed values of the model format: kinds of models and of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message; fixed-width values and messages as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(message):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) if kind != 2 else varint()
        if size is None or at + size > len(message):
            raise ValueError("This is not a model file")
        yield tag >> 3, message[at : at + size]
        at += size


@dataclass
class Model:
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unknown: int = 0
    charsmap: bytes = b""
    prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    pieces: list[tuple[str, float, int]] = field(default_factory=list)


def parse(message: bytes) -> Model:
    model = Model()
    for number, value in fields(message):
        if number == 1:
            piece = dict(fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            spec = dict(fields(value))
            model.kind, model.byte_fallback, model.unknown = spec.get(3, UNIGRAM), bool(spec.get(35, 0)), spec.get(40, 0)
            if spec.get(24, 0):
                raise ValueError("Models with the blank at the end of pieces are not built")
        elif number == 3:
            spec = dict(fields(value))
            model.charsmap = spec.get(2, b"")
            model.prefix, model.squeeze, model.escape = bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1))
    if not model.pieces:
        raise ValueError("The model file has no pieces")
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that join to a piece, best score first."""
    ids = {piece: k for k, (piece, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
    found = []
    for piece, score, kind in model.pieces:
        if kind != NORMAL:
            continue
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in ids and right in ids:
                found.append((-score, ids[piece], ids[left], ids[right], left, right))
    return [(x[4], x[5]) for x in sorted(found)]


def build(model: Model) -> Tokenizer:
    if model.kind == UNIGRAM:
        core = models.Unigram([(piece, score) for piece, score, _ in model.pieces], unk_id=model.unknown, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE(
            {piece: k for k, (piece, _, _) in enumerate(model.pieces)},
            merges(model),
            unk_token=model.pieces[model.unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError(f"Models of kind {model.kind} are not built")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    blank = MARK if model.escape else " "
    if model.prefix:
        steps.append(normalizers.Prepend(blank))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    if model.escape and not any(MARK in piece.lstrip(MARK) for piece, _, _ in model.pieces):
        # No piece holds a blank after anything else, so nothing ever joins across the start of a word.
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    user = [AddedToken(piece, normalized=True) for piece, _, kind in model.pieces if kind == USER]
    if user:
        tokenizer.add_tokens(user)
    tail = [decoders.Replace(MARK, " ")] if model.escape else []
    tail += [decoders.ByteFallback(), decoders.Fuse()]
    if model.prefix:
        tail.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(tail)
    return tokenizer


def encode(tokenizer: Tokenizer, some: list[str]) -> list[list[int]]:
    return [x.ids for x in tokenizer.encode_batch_fast(some, add_special_tokens=False)]


def decode(tokenizer: Tokenizer, some: list[list[int]]) -> list[str]:
    return tokenizer.decode_batch(some, skip_special_tokens=False)


class Runs:
    """A growing list of short arrays, kept as one."""

    def __init__(self, kind):
        self.flat, self.first, self.count = np.zeros(0, kind), np.zeros(1, np.int64), 0

    def add(self, some: list[np.ndarray]) -> None:
        self.flat = np.concatenate((self.flat, *some))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum([len(x) for x in some], dtype=np.int64)))
        self.count += len(some)

    def only(self, which: np.ndarray) -> Runs:
        out = Runs(self.flat.dtype)
        ends, out.flat = self.take(which, np.arange(len(which) + 1))
        out.first, out.count = ends, len(which)
        return out

    def take(self, which: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen arrays one after the other, and where each text's begin (``before`` counts arrays)."""
        first, size = self.first[which], self.first[which + 1] - self.first[which]
        return texts.running(size)[before], self.flat[texts.within(first, size)]


class Codec:
    """Encodes and decodes batches of a model.

    If nothing ever joins across the start of a word and the normaliser changes nothing but blanks, a text's ids are
    those of its units (a word with the blanks before it) in turn, and so is its decoded text. Each unit of a batch is
    encoded and decoded once. Up to ``KEPT`` units are remembered between batches; when there are more, the half that was met
    more often stays. Other models encode and decode whole texts.
    """

    KEPT = 800_000

    #: Units that the library gets at once: its results are large.
    BATCH = 8_192

    def __init__(self, message: bytes):
        self.model = parse(message)
        self.whole = build(self.model)
        self.by_unit = self.whole.pre_tokenizer is not None and not self.model.squeeze and not self.model.charsmap
        if self.by_unit:
            self.bare = build(self.model)
            self.bare.normalizer = None
            self.bare.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
            self._forget()

    def _forget(self) -> None:
        if not hasattr(self, "known") or len(self.known) < 2:
            self.known, self.slot, self.met = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.ids, self.back = Runs(np.int32), Runs(np.uint8)
            return
        stay = np.argsort(-self.met, kind="stable")[: min(len(self.met), self.KEPT) // 2]
        stay.sort()
        slot = self.slot[stay]
        self.known, self.met, self.slot = self.known[stay], self.met[stay] // 2, np.arange(len(stay))
        self.ids, self.back = self.ids.only(slot), self.back.only(slot)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Offsets of each text's ids, all ids, and each text as decoded from them."""
        if not self.by_unit:
            ids = encode(self.whole, [x or "" for x in column.to_pylist()])
            flat = np.fromiter((i for one in ids for i in one), np.int32)
            return texts.running(np.array([len(x) for x in ids])), flat, [x.encode() for x in decode(self.whole, ids)]
        starts, ends, content = texts.spans(column)
        before, key, lead, begin, end = self._split(content, starts, ends)
        distinct, example, unit = np.unique(key, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > self.KEPT:
            self._forget()
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != distinct
        if new.any():
            raw, some = content.tobytes(), example[new]
            units = [MARK * n + raw[a:b].decode() for n, a, b in zip(lead[some].tolist(), begin[some].tolist(), end[some].tolist())]
            self.slot = np.insert(self.slot, at[new], self.ids.count + np.arange(len(units)))
            self.known = np.insert(self.known, at[new], distinct[new])
            self.met = np.insert(self.met, at[new], 0)
            every_id, every_back = [], []
            for k in range(0, len(units), self.BATCH):
                ids = encode(self.bare, units[k : k + self.BATCH])
                every_id += [np.array(x, np.int32) for x in ids]
                every_back += [np.frombuffer(x.encode(), np.uint8) for x in self.bare.decode_batch(ids, skip_special_tokens=False)]
            self.ids.add(every_id)
            self.back.add(every_back)
        found = np.searchsorted(self.known, distinct)
        if len(unit):
            self.met[found] += np.bincount(unit, minlength=len(distinct))
        slot = self.slot[found][unit] if len(unit) else unit
        offsets, ids = self.ids.take(slot, before)
        ends, back = self.back.take(slot, before)
        strip, raw = int(self.model.prefix), back.tobytes()
        return offsets, ids, [raw[a + strip : b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def normal(self, text: str) -> str:
        """What decoding should give back."""
        if self.by_unit:
            return text.replace(MARK, " ")
        return self.whole.normalizer.normalize_str(text).replace(MARK, " ")[int(self.model.prefix) :] if self.whole.normalizer and text else text

    def _split(self, content: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Units of the texts: their number before each text, hash, blanks in front, word."""
        begin, end, before = texts.words(content, starts, ends, _NOT_BLANK)
        last = np.where(before[1:] > before[:-1], end[np.maximum(before[1:], 1) - 1] if len(end) else 0, starts)
        tails = np.flatnonzero(ends > last)  # texts with blanks after their last word
        place = before[1:][tails]
        hashed = texts.word_hashes(content, begin, end) if len(begin) else np.zeros(0, np.uint64)
        hashed = np.insert(hashed, place, np.uint64(0))
        begin, end = np.insert(begin, place, ends[tails]), np.insert(end, place, ends[tails])
        before = before + np.searchsorted(tails, np.arange(len(starts) + 1))
        lead = begin.copy()
        lead[1:] -= end[:-1]
        heads = before[:-1][before[1:] > before[:-1]]
        lead[heads] = begin[heads] - starts[before[1:] > before[:-1]] + int(self.model.prefix)
        return before, texts.mixed(hashed + lead.astype(np.uint64) * np.uint64(texts.BASE)), lead, begin, end


_NOT_BLANK = np.ones(256, dtype=bool)
_NOT_BLANK[0x20] = False


@cache
def codec_of(message: bytes) -> Codec:
    """One for all tasks of a worker: building it takes longer than encoding a small partition, and most units are known then."""
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))  # read when the library first encodes
    return Codec(message)


@cache
def library_of(message: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=message)


def probe(message: bytes, some: list[str]) -> None:
    """Raises if the rebuilt tokenizer and the sentencepiece library disagree on ``some`` texts."""
    theirs = library_of(message)
    codec = Codec(message)
    offsets, ids, back = codec.encode(pa.array(some, pa.string()))
    for k, (text, wanted) in enumerate(zip(some, theirs.encode(some, num_threads=1))):
        if ids[offsets[k] : offsets[k + 1]].tolist() != wanted or back[k].decode() != theirs.decode(wanted):
            raise ValueError(f"The rebuilt tokenizer differs on {text!r}")


def load(path: str) -> bytes:
    """A model file, read where the job is planned. Tasks get its bytes (it is of a fixed size, not the corpus's)."""
    with open(path, "rb") as file:
        return file.read()


def encoded(
    docs: DataFrame, message: bytes, id_col: str = "doc_id", text_col: str = "text", parity_of: int = 1, with_ids: bool = True
) -> DataFrame:
    """``id_col``, n_bytes, n_tokens, ids_sha256 (of the ids as 32-bit little-endian numbers), round_trip, parity, ids.

    round_trip: the ids decode to the text (normalised, if the model normalises). parity: the sentencepiece library gives the same ids;
    it is asked for one text in ``parity_of``, chosen by hash, and null for the others.
    """
    slim = docs.select(
        quoted(id_col).alias("id"),
        quoted(text_col).cast("string").alias("text"),
        (F.pmod(F.xxhash64(quoted(text_col)), F.lit(parity_of)) == 0).alias("ask"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(message)
    schema = [("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("round_trip", pa.bool_()), ("parity", pa.bool_())]
    schema = pa.schema(schema + [("ids", pa.list_(pa.int32()))] * with_ids)

    def convert(batches):
        codec, theirs = codec_of(shared.value), library_of(shared.value)
        for batch in texts.pieces(batches, "text", 1_000_000):
            column = batch.column("text")
            offsets, ids, back = codec.encode(column)
            some = [x or "" for x in column.to_pylist()]
            own = [ids[a:b] for a, b in zip(offsets, offsets[1:])]
            ask = batch.column("ask").to_pylist()
            asked = iter(theirs.encode([x for x, yes in zip(some, ask) if yes], num_threads=1))
            rows = {
                "n_bytes": [len(x.encode()) for x in some],
                "n_tokens": np.diff(offsets),
                "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in own],
                "round_trip": [x.encode() == y for x, y in zip(map(codec.normal, some), back)],
                "parity": [bool(np.array_equal(next(asked), x)) if yes else None for x, yes in zip(own, ask)],
            }
            columns = [pa.array(rows[c], schema.field(c).type) for c in rows]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", *schema.names])

    shape = "n_bytes long, n_tokens long, ids_sha256 string, round_trip boolean, parity boolean" + ", ids array<int>" * with_ids
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(convert, f"id {kind}, {shape}").withColumnRenamed("id", id_col)


def decoded(rows: DataFrame, message: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and the text that the ids stand for. Null ids give a null text."""
    slim = rows.select(quoted(id_col).alias("id"), quoted(ids_col).cast("array<int>").alias("ids"))
    shared = rows.sparkSession.sparkContext.broadcast(message)

    def convert(batches):
        tokenizer = codec_of(shared.value).whole
        for batch in batches:
            some = batch.column("ids").to_pylist()
            back = decode(tokenizer, [x or [] for x in some])
            texts_of = pa.array([None if x is None else y for x, y in zip(some, back)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), texts_of], names=["id", "text"])

    return slim.mapInArrow(convert, f"id {slim.schema['id'].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)
