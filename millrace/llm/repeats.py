"""Suffix-array dedup: bytes covered by a string of a given length that starts anywhere else are removed.

The length is that of a :class:`Window`, 400 bytes if none is given; LENGTH, ANCHOR and WIDTH below are its parts. A window may also say
how many words or bytes a removed run has to hold, so that short strings find passages but are not passages themselves.

Texts are UTF-8 bytes, a null is an empty text. The string may start elsewhere in the same text, and
occurrences may overlap. What is removed is judged on the input, not on what is left.

Method: column-wise construction over many strings. Each round takes one symbol of every string, from right to left, moves the
strings' order by a stable partition on that symbol (the step of a Burrows-Wheeler transform), and
updates the common prefixes of neighbours. A string of LENGTH bytes repeats if the prefix that it shares
with a neighbour reaches LENGTH.

One construction over a whole corpus would need a round for each byte of the longest text, each round a
pass over the transform of all texts. So the texts are cut first, without losing a repeat:

* A window of LENGTH bytes contains ``WIDTH`` runs of ``ANCHOR`` bytes. The run of least hash is its anchor. Equal
  windows have equal anchors at equal places.
* Anchors that occur once are dropped. The others are collected with the WIDTH - 1 bytes to either
  side; all strings of an anchor form a collection in which equal windows stand in the same column. A round
  then is one pass over the strings of a batch of collections, held in memory and bounded.
* Where a text repeats itself with a short period, for long enough, all windows within that stretch repeat. It is noted as one run, and
  of its anchors only one of those that have nothing but the stretch around them is kept.
* An anchor of more than ``GROUP`` strings is refined instead: each band of ``BAND`` columns becomes an anchor of
  its own that is nearly a window long; where not all of its strings agree, its windows are compared
  by hash. Every step there is an aggregation or a join that Spark can split.

Texts are identified by 128 bits, runs and windows by 96 to 128. Rows of equal texts are one text; a text that
several rows have and that is LENGTH or longer (and holds what a window asks for) is removed whole. So repeated rows and repeated or null ids need no
care. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import texts
from millrace.llm.rows import fresh, quoted, text_key
from millrace.scratch import materialize

GROUP = 16_384
BAND = 35


@dataclass(frozen=True)
class Window:
    """What repeats: strings of ``length`` bytes, found by anchors of ``anchor`` bytes.

    If ``words`` is given, a run of bytes so covered is removed only if it holds that many words (between blanks) or ``enough`` bytes.
    """

    length: int = 400
    anchor: int = 128
    words: int | None = None
    enough: int = 400

    @property
    def width(self) -> int:
        """Runs of an anchor's length in a window."""
        return self.length - self.anchor + 1

    @property
    def inner(self) -> int:
        """Length of the anchors that a crowded anchor is refined to."""
        return self.length - BAND + 1

    def holds(self, run: bytes) -> bool:
        """Is a run to be removed?"""
        return self.words is None or len(run) >= self.enough or len(run.split(None, self.words)) >= self.words


WINDOW = Window()

#: Bytes of a long text looked at together.
SLICE = 1_000_000


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least (or largest) of each ``width`` values in a row; runs of doubling length are joined."""
    pick, size = (np.minimum if least else np.maximum), 1
    while 2 * size <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(content: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: Window = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all windows that lie within a text."""
    length, anchor, width = window.length, window.anchor, window.width
    if len(content) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.arange(len(content) - anchor + 1)
    runs = texts.hashes(texts.prefix_sums(content.astype(np.uint64) + np.uint64(1)), first, first + anchor)
    least = _sliding(runs, width, True)
    inside = np.zeros(len(content) + 1, dtype=np.int64)
    long = ends - starts >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    least[np.cumsum(inside)[: len(least)] == 0] = 0
    padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    at = np.flatnonzero((_sliding(padded, width, False) == runs) & (runs > 0))
    return at, runs[at]


def _sliced(content: np.ndarray, window: Window):
    """Anchors of one text, a slice at a time; a slice sees every window around its places."""
    for first in range(0, len(content), SLICE):
        low, high = max(0, first - window.width + 1), min(len(content), first + SLICE + window.length)
        at, runs = anchors(content[low:high], np.array([0]), np.array([high - low]), window)
        at += low
        own = (at >= first) & (at < first + SLICE)
        yield at[own], runs[own]


def _collapsed(content: np.ndarray, at: np.ndarray, runs: np.ndarray, text: np.ndarray, window: Window) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which anchors to keep, and the stretches (start, end) of periods of an anchor's length at most, in which all windows repeat."""
    keep, stretches = np.ones(len(at), dtype=bool), []
    step = np.diff(at)
    # Equal anchors that overlap or touch: what lies between the first and the last of a row has their distance as its period.
    linked = (runs[1:] == runs[:-1]) & (text[1:] == text[:-1]) & (step <= window.anchor)
    edges = np.flatnonzero(np.concatenate(([True], ~linked[1:] | ~linked[:-1] | (step[1:] != step[:-1]), [True]))) if len(step) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1], edges[1:]):
        start, end, period = int(at[a]), int(at[b]) + window.anchor, int(step[a])
        if not linked[a] or end - start < 2 * window.length or (content[start : end - period] != content[start + period : end]).any():
            continue
        stretches.append((start, end))
        inner = np.flatnonzero((at[a : b + 1] - window.width + 1 >= start) & (at[a : b + 1] + window.length <= end))
        keep[a + inner[1:]] = False
    return keep, stretches


def _keyed(docs: DataFrame, text_col: str, *more) -> DataFrame:
    k1, k2 = text_key(quoted(text_col))
    return docs.select(*more, k1.alias("k1"), k2.alias("k2"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"))


def _places(rows: DataFrame, window: Window) -> DataFrame:
    """``run`` (hash of an anchor), k1 and k2, at: every anchor of every text; with ``end`` and no ``run``, a stretch that repeats."""

    def find(batches):
        for batch in texts.pieces(batches, "text", SLICE):
            starts, ends, content = texts.spans(batch.column("text"))
            for at, runs in _sliced(content, window) if len(batch) == 1 else [anchors(content, starts, ends, window)]:
                text = np.searchsorted(ends, at, side="right")
                keep, stretches = _collapsed(content, at, runs, text, window)
                first = np.array([a for a, _ in stretches], np.int64)
                last = np.array([b for _, b in stretches], np.int64)
                text = np.concatenate((text[keep], np.searchsorted(ends, first, side="right")))
                n, begin, row = int(keep.sum()), starts[text], pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(runs[keep].view(np.int64), first * 0), mask=np.arange(len(text)) >= n),
                        batch.column("k1").take(row),
                        batch.column("k2").take(row),
                        pa.array(np.append(at[keep], first) - begin),
                        pa.array(np.append(at[keep] * 0, last) - begin, mask=np.arange(len(text)) < n),
                    ],
                    names=["run", "k1", "k2", "at", "end"],
                )

    return rows.where(F.octet_length("text") >= window.length).mapInArrow(find, "run long, k1 long, k2 long, at long, end long")


def _place() -> Column:
    return F.xxhash64("k1", "k2", "at")


def _candidates(rows: DataFrame, window: Window) -> tuple[DataFrame, DataFrame]:
    """Distinct anchors (run, k1, k2, at) whose run stands in two places at least; and stretches (k1, k2, start, end)."""
    places = materialize(_places(rows, window), "anchors")
    found = places.where("end is null").drop("end")
    twice = found.groupBy("run").agg(F.min(_place()).alias("a"), F.max(_place()).alias("b")).where("a <> b").select("run")
    # Written, so that the join has a plain scan on both sides and Spark can split a run that very many places have;
    # as one column, so that rows that a common run has are told apart by hashes of their own.
    rows = found.join(materialize(twice, "runs"), "run").select(F.struct("run", "k1", "k2", "at").alias("row"))
    stretches = places.where("end is not null").select("k1", "k2", F.col("at").alias("start"), "end")
    return materialize(rows.distinct().select("row.*"), "candidates"), stretches


def _cut(chosen: DataFrame, window: Window) -> tuple[DataFrame, DataFrame]:
    """Strings around the anchors of ``chosen`` (k1, k2, text, anchors); those of crowded anchors refined."""
    reach, anchor, inner = window.width - 1, window.anchor, window.inner

    def plain(batches):
        for batch in batches:
            for part in texts.pieces(iter([batch]), "text", 256_000):
                out = {c: [] for c in ("run", "check", "k1", "k2", "at", "left", "right")}
                for k1, k2, text, found in zip(*(part.column(c).to_pylist() for c in ("k1", "k2", "text", "anchors"))):
                    raw = text.encode()
                    for one in found:
                        if one["crowded"]:
                            continue
                        a, b = one["at"], one["at"] + anchor
                        row = (one["run"], zlib.crc32(raw[a:b]), k1, k2, a, raw[max(0, a - reach) : a], raw[b : b + reach])
                        for c, value in zip(out, row):
                            out[c].append(value)
                yield pa.RecordBatch.from_pydict(out, pa.schema([*((c, pa.int64()) for c in list(out)[:5]), ("left", pa.binary()), ("right", pa.binary())]))

    def refined(batches):
        for batch in batches:
            for part in texts.pieces(iter([batch]), "text", 256_000):
                out = {c: [] for c in ("run", "k1", "k2", "at", "left", "right")}
                for k1, k2, text, found in zip(*(part.column(c).to_pylist() for c in ("k1", "k2", "text", "anchors"))):
                    raw = text.encode()
                    for one in found:
                        for a in range(one["at"], one["at"] - reach - 1, -BAND) if one["crowded"] else ():
                            b = a + inner
                            if a >= 0 and b <= len(raw):
                                row = (xxhash.xxh128_digest(raw[a:b]), k1, k2, a, raw[max(0, a - BAND + 1) : a], raw[b : b + BAND - 1])
                                for c, value in zip(out, row):
                                    out[c].append(value)
                yield pa.RecordBatch.from_pydict(
                    out, pa.schema([("run", pa.binary()), *((c, pa.int64()) for c in list(out)[1:4]), ("left", pa.binary()), ("right", pa.binary())])
                )

    tail = "k1 long, k2 long, at long, left binary, right binary"
    crowded = chosen.where(F.exists("anchors", lambda x: x["crowded"]))
    return chosen.mapInArrow(plain, f"run long, check long, {tail}"), crowded.mapInArrow(refined, f"run binary, {tail}")


def columns(group: np.ndarray, left: list[bytes], right: list[bytes], anchor: int, reach: int) -> np.ndarray:
    """For each string and number of bytes left of its anchor (0 to ``reach``): does that window repeat in its group?

    ``group`` numbers the collections, in order. A window has ``reach`` bytes beside the anchor.
    """
    size = len(group)
    ahead, behind = _symbols(right, reach), _symbols([x[::-1] for x in left], reach)
    order = np.arange(size)
    shared = np.zeros(size, np.int64)  # symbols that a string in order shares with the one before it
    repeats = np.zeros((size, reach + 1), dtype=bool)

    def insert(symbols: np.ndarray) -> None:
        nonlocal order, shared
        now = symbols[order]
        key = group[order] * 257 + now
        moved = np.argsort(key, kind="stable")
        if (moved[1:] > moved[:-1]).all():
            low = shared
        else:
            # Neighbours in the new order that were apart share the least of what lies between them.
            low = np.zeros(size, np.int64)
            a, b = moved[:-1], moved[1:]
            pair = np.flatnonzero((key[a] == key[b]) & (a < b))
            bounds = np.empty(2 * len(pair), np.int64)
            bounds[::2], bounds[1::2] = a[pair] + 1, b[pair] + 1
            if len(pair):
                low[pair + 1] = np.minimum.reduceat(np.append(shared, 0), bounds)[::2]
        same = np.zeros(size, dtype=bool)
        same[1:] = (key[moved][1:] == key[moved][:-1]) & (now[moved][1:] > 0)
        shared = np.where(same, low + 1, 0)
        order = order[moved]

    def note(column: int) -> None:
        hit = shared >= anchor + reach
        hit[:-1] |= hit[1:]
        repeats[order[hit], column] = True

    for k in range(reach - 1, -1, -1):
        insert(ahead[k])
    same = np.zeros(size, dtype=bool)
    same[1:] = group[1:] == group[:-1]  # the order never leaves a group, so the groups lie as they did
    shared = np.where(same, shared + anchor, 0)
    note(0)
    for k in range(reach):
        insert(behind[k])
        note(k + 1)
    return repeats


def _symbols(strings: list[bytes], reach: int) -> np.ndarray:
    """Symbol k of every string as row k: 1 to 256, or 0 beyond its end."""
    size = np.array([len(x) for x in strings], np.int64)
    out = np.zeros((len(strings), reach), np.int16)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    out[np.repeat(np.arange(len(strings)), size), texts.within(np.zeros(len(strings), np.int64), size)] = flat.astype(np.int16) + 1
    return np.ascontiguousarray(out.T)


def _repeated(strings: DataFrame, window: Window) -> DataFrame:
    """k1, k2, start, end: bytes covered by repeated windows around anchors that are not crowded."""

    def construct(batches):
        for table in _collections(batches):
            group = np.concatenate(([0], np.cumsum((table["run"][1:] != table["run"][:-1]) | (table["check"][1:] != table["check"][:-1]))))
            found = columns(group, table["left"], table["right"], window.anchor, window.width - 1)
            edges = np.diff(np.pad(found.view(np.int8), ((0, 0), (1, 1))), axis=1)
            row, first = np.nonzero(edges == 1)
            _, last = np.nonzero(edges == -1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(table["k1"][row]),
                    pa.array(table["k2"][row]),
                    pa.array(table["at"][row] - last + 1),
                    pa.array(table["at"][row] - first + window.length),
                ],
                names=["k1", "k2", "start", "end"],
            )

    dealt = strings.repartition("run").sortWithinPartitions("run", "check")
    return dealt.mapInArrow(construct, "k1 long, k2 long, start long, end long")


def _collections(batches, most: int = 8_000):
    """Sorted rows in runs of whole collections, of about ``most`` rows."""
    rest: list[pa.RecordBatch] = []

    def table(part: pa.Table) -> dict:
        out = {c: part.column(c).to_numpy() for c in ("run", "check", "k1", "k2", "at")}
        return out | {c: part.column(c).to_pylist() for c in ("left", "right")}

    for batch in batches:
        for k in range(0, len(batch), most):
            rest.append(batch.slice(k, most))
            if sum(map(len, rest)) < most:
                continue
            joined = pa.Table.from_batches(rest)
            runs = joined.column("run").to_numpy()
            last = np.flatnonzero(runs[1:] != runs[:-1])
            if len(last):
                yield table(joined.slice(0, last[-1] + 1))
                joined = joined.slice(last[-1] + 1)
            rest = joined.combine_chunks().to_batches()
    if rest and sum(map(len, rest)):
        yield table(pa.Table.from_batches(rest))


def _repeated_in_crowds(bands: DataFrame, window: Window) -> DataFrame:
    """The same for refined anchors. Rows of an anchor are never brought together: they meet in sums and joins.

    What stands around an anchor in several places repeats as a whole. What stands around it once is compared
    window by window with every other surrounding that the anchor has.
    """
    bands = materialize(bands.withColumn("around", F.xxhash64("left", "right")), "bands")
    once = {c: F.first(c).alias(c) for c in ("k1", "k2", "at", "left", "right")}
    around = materialize(
        bands.groupBy("run", "around")
        .agg((F.min(_place()) == F.max(_place())).alias("single"), *once.values())
        .withColumns({"fewest": F.greatest(F.lit(0), F.lit(BAND - 1) - F.octet_length("right")), "most": F.octet_length("left")})
        .where("fewest <= most"),
        "around",
    )
    whole = bands.select("run", "around", "k1", "k2", "at").join(
        around.where("not single").select("run", "around", "fewest", "most"), ["run", "around"]
    )
    whole = whole.select("k1", "k2", (F.col("at") - F.col("most")).alias("start"), (F.col("at") - F.col("fewest") + window.length).alias("end"))
    several = materialize(
        around.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.max("single").alias("any")).where("n > 1 and any").select("run"), "runs"
    )
    windows = (
        around.join(several, "run")
        .withColumn("n", F.explode(F.sequence("fewest", "most")))
        .withColumn("l", F.expr("substring(left, octet_length(left) - n + 1, n)"))
        .withColumn("r", F.expr(f"substring(right, 1, {BAND - 1} - n)"))
        .select(
            "single", "k1", "k2", (F.col("at") - F.col("n")).alias("at"),
            F.xxhash64("run", "n", "l", "r").alias("w1"), F.xxhash64("r", "l", "n", "run").alias("w2"),
        )
    )
    windows = materialize(windows, "windows")
    twice = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2")
    twice = materialize(twice, "twice")
    found = windows.where("single").join(twice, ["w1", "w2"]).select("k1", "k2", F.col("at").alias("start"), (F.col("at") + window.length).alias("end"))
    return whole.unionByName(found)


def _merged(found: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((x["start"], x["end"]) for x in found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def kept(raw: bytes, cut: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in cut:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def kept_text(raw: bytes, cut: list[tuple[int, int]]) -> str:
    """What is left if characters that a run covers only in part stay."""

    def inner(at: int, step: int) -> int:
        while 0 < at < len(raw) and raw[at] & 0xC0 == 0x80:
            at += step
        return at

    whole = [(inner(a, 1), inner(b, -1)) for a, b in cut]
    return kept(raw, [(a, b) for a, b in whole if a < b]).decode()


def _texts_with_repeats(docs: DataFrame, text_col: str, window: Window) -> DataFrame:
    """k1, k2, cut (merged runs), kept_sha256 and kept_text of texts in which something repeats and that one row has."""
    rows = _keyed(docs, text_col)
    places, stretches = _candidates(rows.select("k1", "k2", "text"), window)
    crowds = places.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP).select("run", F.lit(True).alias("crowded"))
    crowds = materialize(crowds, "crowds")
    lists = (
        places.join(crowds, "run", "left")
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct("at", "run", F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("anchors"))
    )
    distinct = rows.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    chosen = materialize(distinct.join(lists, ["k1", "k2"]), "chosen")
    strings, bands = _cut(chosen, window)
    found = materialize(_repeated(strings, window).unionByName(_repeated_in_crowds(bands, window)).unionByName(stretches), "found")
    # Runs of one text lie close together, so that they are joined once before they are collected.
    runs = found.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    single = chosen.where("copies = 1").select("k1", "k2", "text").join(runs, ["k1", "k2"])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches):
        for batch in texts.pieces(batches, "text"):
            raws = [x.encode() for x in batch.column("text").to_pylist()]
            cuts = [_merged(x) for x in batch.column("found").to_pylist()]
            cuts = [[(a, b) for a, b in x if window.holds(raw[a:b])] for raw, x in zip(raws, cuts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k1"),
                    batch.column("k2"),
                    pa.array([[{"start": a, "end": b} for a, b in x] for x in cuts], kind),
                    pa.array([hashlib.sha256(kept(raw, x)).hexdigest() for raw, x in zip(raws, cuts)]),
                    pa.array([kept_text(raw, x) for raw, x in zip(raws, cuts)]),
                ],
                names=["k1", "k2", "cut", "kept_sha256", "kept_text"],
            )

    shape = "k1 long, k2 long, cut array<struct<start:long,end:long>>, kept_sha256 string, kept_text string"
    return single.mapInArrow(cut, shape)


def _copied(docs: DataFrame, text_col: str, window: Window) -> DataFrame:
    """k1 and k2 of texts of the window's length or more that several rows have."""
    rows = _keyed(docs, text_col).where(F.octet_length("text") >= window.length)
    if window.words is not None:
        # Counted up to the number wanted.
        words = F.size(F.filter(F.split("text", r"[ \t\n\x0B\f\r]+", window.words + 2), lambda word: word != ""))
        rows = rows.where((F.octet_length("text") >= window.enough) | (words >= window.words))
    return rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k1", "k2")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: Window = WINDOW) -> DataFrame:
    """``id_col``, n_bytes, cut (runs of removed bytes) and kept_sha256 of each row."""
    some = materialize(_texts_with_repeats(docs, text_col, window).select("k1", "k2", "cut", "kept_sha256"), "cut")
    # A text is in one of the two tables at most.
    all_of = _copied(docs, text_col, window).select("k1", "k2", F.lit(None).cast(some.schema["cut"].dataType).alias("cut"), F.sha2(F.lit(""), 256).alias("kept_sha256"), F.lit(True).alias("whole"))
    known = some.withColumn("whole", F.lit(False)).unionByName(all_of).withColumnsRenamed({"kept_sha256": "sha"})
    rows = _keyed(docs, text_col, quoted(id_col).alias("id")).select(
        "id", "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("own")
    )
    joined = rows.join(known, ["k1", "k2"], "left")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    cut = F.when(F.col("whole"), everything).otherwise(F.coalesce("cut", F.array().cast(some.schema["cut"].dataType)))
    return joined.select(F.col("id").alias(id_col), "n_bytes", cut.alias("cut"), F.coalesce("sha", "own").alias("kept_sha256"))


def remove(docs: DataFrame, text_col: str = "text", n_chars_col: str | None = None, window: Window = WINDOW) -> DataFrame:
    """``docs`` with the repeated bytes cut out of the text; all rows and columns stay.

    A character of which a run covers only some bytes stays. A null text stays null. ``n_chars_col`` names
    a column that gets the new number of characters.
    """
    some = _texts_with_repeats(docs, text_col, window).select("k1", "k2", F.col("kept_text").alias("new"))
    known = materialize(some.unionByName(_copied(docs, text_col, window).withColumn("new", F.lit(""))), "kept")
    names = fresh(docs, "k1", "k2", "new")
    keyed = docs.withColumns(dict(zip(names, text_key(quoted(text_col)))))
    same = fresh(keyed, "own_k1", "own_k2")
    known = known.toDF(*same, names[2])
    joined = keyed.join(known, (F.col(names[0]) == F.col(same[0])) & (F.col(names[1]) == F.col(same[1])), "left")
    new = {text_col: F.coalesce(F.col(names[2]), quoted(text_col))}
    out = joined.withColumns(new)
    if n_chars_col is not None:
        kind = docs.schema[n_chars_col].dataType
        out = out.withColumn(n_chars_col, F.when(F.col(names[2]).isNull(), quoted(n_chars_col)).otherwise(F.length(text_col)).cast(kind))
    return out.select([quoted(c) for c in docs.columns])
