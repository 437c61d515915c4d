"""Benchmark decontamination: windows of the test texts, broadcast, looked up in the training texts.

A text is lower-cased (A-Z) and cut into words of 0-9, a-z and bytes beyond ASCII. A window is
``width`` consecutive words of a benchmark item; an item of fewer words is one window, an item of
none has no window. A document's word is hit if it lies in an occurrence of a window. A document is
contaminated if words are hit and they are at least one in ``share``.

The windows are looked up by hash and every hit is compared word by word. They are broadcast, as a block of at most
``block_mb``. A benchmark of more windows is dealt into blocks, and the texts are read once per block: only one block is fetched,
broadcast and held at a time, the hits it finds are written, and in the end those of all blocks are merged per text. So
neither the driver nor a task ever holds more than a block, however large the benchmark.

Nulls: a null text has no words; an item without id counts as hit words but is not named. Repeated
items count once by their id. An empty benchmark hits nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import texts
from millrace.llm.rows import fresh, quoted
from millrace.scratch import materialize

WIDTH = 13
SHARE = 20
BLOCK_MB = 32

FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per distinct window and item: n (words), window (words joined by blanks), item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.pieces(batches, "text"):
            low, begin, end, before, _ = _read(batch.column("text"))
            out = {"n": [], "window": [], "item": []}
            raw = low.tobytes()
            for k, item in enumerate(batch.column("item").to_pylist()):
                own = [raw[b:e] for b, e in zip(begin[before[k] : before[k + 1]], end[before[k] : before[k + 1]])]
                for i in range(max(1, len(own) - width + 1) if own else 0):
                    part = own[i : i + width]
                    out["n"].append(len(part))
                    out["window"].append(b" ".join(part))
                    out["item"].append(item)
            yield pa.RecordBatch.from_pydict(out, pa.schema([("n", pa.int32()), ("window", pa.binary()), ("item", pa.string())]))

    named = items.select(quoted(id_col).cast("string").alias("item"), quoted(text_col).cast("string").alias("text"))
    return named.mapInArrow(cut, "n int, window binary, item string").distinct()


class Windows:
    """A block of windows: a sorted array of hashes for each number of words, and what they stand for."""

    def __init__(self, rows: list[tuple[int, bytes, str | None]]):
        self.of: dict[bytes, list[str]] = {}
        lengths: dict[int, set[bytes]] = {}
        for n, window, item in rows:
            named = self.of.setdefault(bytes(window), [])
            if item is not None:
                named.append(item)
            lengths.setdefault(n, set()).add(bytes(window))
        self.hashes = {}
        for n, some in lengths.items():
            flat = np.frombuffer(b"\x00".join(some), np.uint8)
            ends = texts.running(np.fromiter((len(x) + 1 for x in some), np.int64, len(some)))
            begin, end, _ = texts.words(flat, ends[:-1], ends[1:] - 1, _SEPARATED)
            self.hashes[n] = np.unique(texts.hashes(texts.prefix_sums(texts.word_hashes(flat, begin, end)), *_runs(len(begin), n, n)))

    def hits(self, n: int, found: np.ndarray) -> np.ndarray:
        known = self.hashes[n]
        at = np.searchsorted(known, found)
        at[at == len(known)] = 0
        return np.flatnonzero(known[at] == found)


#: What separates words within and between windows.
_SEPARATED = np.ones(256, dtype=bool)
_SEPARATED[[0x00, 0x20]] = False


def _runs(total: int, n: int, step: int = 1) -> tuple[np.ndarray, np.ndarray]:
    first = np.arange(0, max(0, total - n + 1), step)
    return first, first + n


def _read(column: pa.Array):
    starts, ends, content = texts.spans(column)
    low = texts.LOWER[content]
    begin, end, before = texts.words(low, starts, ends, texts.ALPHANUMERIC)
    return low, begin, end, before, starts


def scan(column: pa.Array, blocks: list[Windows]):
    """For each text: number of words, number of hit words, items, byte spans of the hit runs, and these runs in words."""
    low, begin, end, before, starts = _read(column)
    rows = len(column)
    change = np.zeros(len(begin) + 1, dtype=np.int64)
    items: list[set[str]] = [set() for _ in range(rows)]
    if len(begin):
        raw = low.tobytes()
        of_text = np.repeat(np.arange(rows), np.diff(before))
        sums = texts.prefix_sums(texts.word_hashes(low, begin, end))
        for n in sorted({n for block in blocks for n in block.hashes}):
            first, last = _runs(len(begin), n)
            same = of_text[first] == of_text[last - 1]
            first, last = first[same], last[same]
            found = texts.hashes(sums, first, last)
            for block in blocks:
                if n not in block.hashes:
                    continue
                for i in block.hits(n, found):
                    i, j = first[i], last[i]
                    named = block.of.get(b" ".join(raw[b:e] for b, e in zip(begin[i:j], end[i:j])))
                    if named is not None:  # else only the hashes agree
                        change[i] += 1
                        change[j] -= 1
                        items[of_text[i]].update(named)
    hit = np.cumsum(change)[:-1] > 0
    hit_before = texts.running(hit)
    out = []
    for k in range(rows):
        a, b = before[k], before[k + 1]
        out.append(_told(hit[a:b], begin[a:b], end[a:b], starts[k], items[k], int(hit_before[b] - hit_before[a])))
    return out


def _told(hit: np.ndarray, begin: np.ndarray, end: np.ndarray, start: int, items: set[str], n_hit: int):
    first, last = _hit_runs(hit)
    spans = [(int(begin[a] - start), int(end[b] - start)) for a, b in zip(first, last)]
    return len(hit), n_hit, items, spans, list(zip(first.tolist(), last.tolist()))


def _hit_runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each run of hit words."""
    if not hit.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


_RUNS = "array<struct<first:int,last:int>>"


def _found(docs: DataFrame, text_col: str, benchmark: DataFrame, id_col: str, item_text: str, width: int, block_mb: float):
    """``docs`` (and columns ``runs`` and ``items``, if there are several blocks), and what finds the hits of a batch of them."""
    spark = benchmark.sparkSession
    rows = windows(benchmark, id_col, item_text, width)
    size = rows.agg(F.sum(F.length("window") + F.coalesce(F.length("item"), F.lit(0)) + 64)).first()[0] or 0
    parts = math.ceil(size / (block_mb * (1 << 20)))

    def fetched(some: DataFrame):
        return spark.sparkContext.broadcast([(r.n, bytes(r.window), r.item) for r in some.collect()])

    if parts <= 1:
        share = fetched(rows) if parts else None

        def opened():
            blocks = [Windows(share.value)] if share is not None else []
            return lambda batch: scan(batch.column(text_col), blocks)

        return docs, opened
    rows = materialize(rows, "windows")
    (row,) = fresh(docs, "row")
    # Written, so that a text keeps its number from block to block.
    docs = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "texts")
    found = []
    for k in range(parts):
        share = fetched(rows.where(F.pmod(F.xxhash64("window", "item"), F.lit(parts)) == k))
        found.append(materialize(_of_block(docs, row, text_col, share), "hits"))
        share.destroy()
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    # A text has a row per block at most, so what is gathered is bounded by its words.
    merged = every.groupBy("row").agg(F.flatten(F.collect_list("runs")).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    names = fresh(docs, "runs", "items")
    merged = merged.toDF("own_row", *names)
    docs = docs.join(merged, quoted(row) == F.col("own_row"), "left").drop("own_row", row)

    def opened():
        def told(batch: pa.RecordBatch):
            _, begin, end, before, starts = _read(batch.column(text_col))
            out = []
            for k, (runs, items) in enumerate(zip(*(batch.column(c).to_pylist() for c in names))):
                a, b = before[k], before[k + 1]
                hit = np.zeros(b - a, dtype=bool)
                for run in runs or ():
                    hit[run["first"] : run["last"] + 1] = True
                out.append(_told(hit, begin[a:b], end[a:b], starts[k], set(items or ()), int(hit.sum())))
            return out

        return told

    return docs, opened


def _of_block(docs: DataFrame, row: str, text_col: str, share: Broadcast) -> DataFrame:
    """row, runs and items of the texts that windows of a block hit."""
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def look(batches):
        blocks = [Windows(share.value)]
        for batch in texts.pieces(batches, "text"):
            found = scan(batch.column("text"), blocks)
            some = [k for k, x in enumerate(found) if x[4]]
            runs = pa.array([[{"first": a, "last": b} for a, b in found[k][4]] for k in some], kind)
            items = pa.array([sorted(found[k][2]) for k in some], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(some, pa.int64())), runs, items], names=["row", "runs", "items"])

    slim = docs.select(quoted(row).alias("row"), quoted(text_col).cast("string").alias("text"))
    return slim.mapInArrow(look, f"row long, runs {_RUNS}, items array<string>")


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    block_mb: float = BLOCK_MB,
) -> DataFrame:
    """``id_col``, n_words, n_hit, items (ids as strings, sorted) and spans (bytes of hit runs) of each text."""
    schema = pa.schema(
        [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
    )
    slim = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    slim, opened = _found(slim, "text", benchmark, item_col, item_text, width, block_mb)

    def look(batches):
        told = opened()
        for batch in texts.pieces(batches, "text"):
            found = told(batch)
            columns = [
                pa.array([x[0] for x in found], pa.int64()),
                pa.array([x[1] for x in found], pa.int64()),
                pa.array([sorted(x[2]) for x in found], schema.field("items").type),
                pa.array([[{"start": a, "end": b} for a, b in x[3]] for x in found], schema.field("spans").type),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", *schema.names])

    return slim.mapInArrow(look, f"id {kind}, {FOUND}").withColumnRenamed("id", id_col)


def contaminated(n_words: int, n_hit: int, share: int = SHARE) -> bool:
    return n_hit > 0 and share * n_hit >= n_words


def remove(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", how: str = "documents", share: int = SHARE, **options
) -> DataFrame:
    """``docs`` without the contaminated ones, or with the hit runs cut out of the text (``how="spans"``).

    All columns stay. A null text is clean and stays null.
    """
    if how not in ("documents", "spans"):
        raise ValueError(f"how is 'documents' or 'spans', not {how!r}")
    item_col, item_text = options.get("item_col", "item_id"), options.get("item_text", "text")
    rows, opened = _found(docs, text_col, benchmark, item_col, item_text, options.get("width", WIDTH), options.get("block_mb", BLOCK_MB))
    columns = docs.columns

    def clean(batches):
        told = opened()
        for batch in texts.pieces(batches, text_col):
            found = told(batch)
            batch = batch.select(columns)
            if how == "documents":
                yield batch.filter(pa.array([not contaminated(x[0], x[1], share) for x in found], pa.bool_()))
                continue
            new = []
            for text, (_, _, _, cut, _) in zip(batch.column(text_col).to_pylist(), found):
                if cut:
                    raw, kept, at = text.encode(), b"", 0
                    for a, b in cut:
                        kept, at = kept + raw[at:a], b
                    text = (kept + raw[at:]).decode()
                new.append(text)
            k = batch.schema.get_field_index(text_col)
            yield batch.set_column(k, batch.schema.field(k), pa.array(new, batch.schema.field(k).type))

    return rows.mapInArrow(clean, docs.schema)
