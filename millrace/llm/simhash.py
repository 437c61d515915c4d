"""SimHash near-duplicates, found by anchor-point covering.

Fingerprint: a text is lower-cased (A-Z) and cut at blanks into words; each run of ``shingle`` words,
joined by single blanks and counted as often as it occurs, is hashed (XXH64, seed 42). A bit is 1 if
it is set in more than half the hashes. Fewer words than ``shingle`` are one shingle; no words give 0.

Two fingerprints link at ``most`` differing bits or fewer. The 64 bits are cut into parts; a pair
that links differs in at most most // parts bits of some part. In each part the words of a covering
code are the anchors: a perfect Hamming code (radius 1) with free bits beside it. A
fingerprint lives at the anchor nearest to it and visits every anchor within radius plus threshold,
so every linked pair meets at the home anchor of either one. There, all 64 bits are compared.

Of n random fingerprints one is compared with n / 3,500 others in ``THIRDS`` (2^19 anchors, 45 visits) and with n / 391,000
in ``HALVES`` (2^28 anchors, 343 visits). Beyond ``WIDE`` distinct fingerprints the comparisons of the thirds
would cost more than the visits of the halves, which then are taken; the components are the same.

Equal fingerprints are one vertex. At an anchor, homes and visitors are dealt into blocks of at
most ``BLOCK`` each and a block's links are reduced to a spanning forest, so that neither a task nor the
result grows with the square of a group. Components of the forest are those of all links.

Nulls: a null text has no words; a null id is kept and never the name of a component unless all of
its ids are null. Equal ids and texts are rows of their own.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import texts
from millrace.llm.components import components
from millrace.llm.rows import fresh, quoted, text_key
from millrace.scratch import materialize

SHINGLE = 4
MOST = 4
SEED = 42



class Cut(NamedTuple):
    """First bit and number of bits of each part, and bits of its code; the rest are free."""

    parts: tuple[tuple[int, int], ...]
    code: int


THIRDS = Cut(((0, 21), (21, 21), (42, 22)), 15)
HALVES = Cut(((0, 32), (32, 32)), 31)

#: Distinct fingerprints beyond which the bits are cut into halves.
WIDE = 50_000_000

#: Homes, and visitors, compared at once.
BLOCK = 2048


def fingerprint_of(batch: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprints of texts, as uint64."""
    out = np.zeros(len(batch), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for k, raw in enumerate(pc.fill_null(batch, "").cast(pa.large_binary()).to_pylist()):
        flat = b" ".join(raw.lower().split())
        if not flat:
            continue
        blanks = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
        first = np.concatenate(([0], blanks + 1))
        last = np.concatenate((blanks, [len(flat)]))
        n = max(1, len(first) - shingle + 1)
        hashed = np.fromiter(
            [digest(flat[a:b], SEED) for a, b in zip(first[:n].tolist(), last[min(shingle, len(last)) - 1 :].tolist())], np.uint64, n
        )
        set_bits = _bit_counts(hashed)
        out[k] = np.packbits((2 * set_bits > n)[::-1]).view(">u8")[0]
    return out


def _bit_counts(hashed: np.ndarray) -> np.ndarray:
    """How many of the hashes have bit 0, 1, ... set; in bounded slices."""
    total = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashed), 1 << 16):
        part = hashed[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id``, ``k1`` and ``k2`` (key of the text) and ``bits`` (the fingerprint as a signed long) of each row."""
    text = quoted(text_col).cast("string")
    k1, k2 = text_key(text)
    slim = docs.select(quoted(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), text.alias("text"))

    def shrink(batches):
        for batch in texts.pieces(batches, "text"):
            bits = fingerprint_of(batch.column("text"), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(bits)], names=["id", "k1", "k2", "bits"])

    return slim.mapInArrow(shrink, f"id {slim.schema['id'].dataType.simpleString()}, k1 long, k2 long, bits long")


@cache
def _balls(bits: int, reach: int) -> np.ndarray:
    """All words of ``bits`` bits with at most ``reach`` ones."""
    return np.array([sum(1 << i for i in ones) for n in range(reach + 1) for ones in combinations(range(bits), n)], dtype=np.uint64)


@cache
def _parities(code: int) -> tuple[np.ndarray, ...]:
    """For each byte of a word the XOR of the numbers (from 1) of its ones, as far as they are bits of the code."""
    numbers = [[8 * byte + i + 1 if 8 * byte + i < code else 0 for i in range(8)] for byte in range(-(-code // 8))]
    ones = np.arange(256)[:, None] >> np.arange(8) & 1
    return tuple(np.bitwise_xor.reduce(ones * np.array(n), axis=1) for n in numbers)


def syndromes(words: np.ndarray, code: int) -> np.ndarray:
    """0 for words of the code, else the number (from 1) of the bit that leads to one."""
    out = np.zeros(len(words), dtype=np.int64)
    for byte, table in enumerate(_parities(code)):
        out ^= table[(words >> np.uint64(8 * byte) & np.uint64(255)).astype(np.int64)]
    return out


def home(words: np.ndarray, code: int) -> np.ndarray:
    """The anchor next to each word: the bit that the syndrome names is flipped, free bits stay."""
    s = syndromes(words, code)
    return words ^ np.where(s > 0, np.uint64(1) << np.maximum(s - 1, 0).astype(np.uint64), np.uint64(0))


def visits(words: np.ndarray, bits: int, code: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Every anchor within ``reach`` of each word: index of the word, anchor.

    A flip leads to the code if its syndrome is the word's.
    """
    flips = _balls(bits, reach)
    of_word, of_flip = syndromes(words, code), syndromes(flips, code)
    index, anchors = [], []
    for s in range(code + 1):
        at, own = np.flatnonzero(of_word == s), flips[of_flip == s]
        index.append(np.repeat(at, len(own)))
        anchors.append((words[at][:, None] ^ own).ravel())
    return np.concatenate(index), np.concatenate(anchors)


def cover(bits: pd.Series, most: int = MOST, cut: Cut = THIRDS) -> pd.DataFrame:
    """Rows (anchor, home, bits) of fingerprints: each at its home and at every anchor it visits, in each part."""
    own = bits.to_numpy(np.int64)
    values, out = own.view(np.uint64), []
    for k, (first, size) in enumerate(cut.parts):
        part = values >> np.uint64(first) & np.uint64((1 << size) - 1)
        tag = np.uint64(k << 32)
        index, anchors = visits(part, size, cut.code, 1 + most // len(cut.parts))
        out.append(pd.DataFrame({"anchor": (home(part, cut.code) | tag).astype(np.int64), "home": True, "bits": own}))
        out.append(pd.DataFrame({"anchor": (anchors | tag).astype(np.int64), "home": False, "bits": own[index]}))
    return pd.concat(out, ignore_index=True)


def forest(homes: np.ndarray, visitors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what all links between homes and visitors connect, no more than vertices."""
    values = np.unique(np.concatenate((homes, visitors)))
    root = np.arange(len(values))
    rows, across = np.searchsorted(values, homes), np.searchsorted(values, visitors)
    for k in range(0, len(homes), 256):
        near = np.bitwise_count(homes[k : k + 256, None] ^ visitors[None, :]) <= most
        a, b = np.nonzero(near)
        a, b = rows[k + a], across[b]
        while True:
            x, y = root[a], root[b]
            low = np.minimum(x, y)
            if (x == y).all():
                break
            np.minimum.at(root, np.maximum(x, y), low)
            while not (root == root[root]).all():
                root = root[root]
    linked = np.flatnonzero(root != np.arange(len(root)))
    return values[linked], values[root[linked]]


def links(distinct_bits: DataFrame, most: int = MOST) -> DataFrame:
    """``a`` and ``b``: fingerprints that link, as many as connect all that do."""
    if most > 5:
        raise ValueError("The parts allow 5 differing bits at most")
    cut = HALVES if distinct_bits.count() > WIDE else THIRDS
    shape = "anchor long, home boolean, bits long"

    def spread(batches):
        for pdf in batches:
            for k in range(0, len(pdf), 4096):
                yield cover(pdf["bits"].iloc[k : k + 4096], most, cut)

    placed = materialize(distinct_bits.select("bits").mapInPandas(spread, shape), "anchors")
    sizes = (
        placed.groupBy("anchor")
        .agg(F.sum(F.col("home").cast("long")).alias("homes"), F.sum((~F.col("home")).cast("long")).alias("visitors"))
        .where("homes > 0 and visitors > 1")
        .select("anchor", F.ceil(F.col("homes") / BLOCK).alias("down"), F.ceil(F.col("visitors") / BLOCK).alias("wide"))
    )
    lot = F.pmod(F.xxhash64("bits"), F.when(F.col("home"), F.col("down")).otherwise(F.col("wide")))
    others = F.sequence(F.lit(0).cast("long"), F.when(F.col("home"), F.col("wide")).otherwise(F.col("down")) - 1)
    dealt = (
        placed.join(sizes, "anchor")
        .withColumn("lot", lot)
        .withColumn("other", F.explode(others))
        .select(
            "anchor",
            F.when(F.col("home"), F.col("lot")).otherwise(F.col("other")).alias("row"),
            F.when(F.col("home"), F.col("other")).otherwise(F.col("lot")).alias("across"),
            "home",
            "bits",
        )
    )

    def compare(batches):
        for table in _groups(batches):
            keys, at_home, bits = table
            a, b = _forests(keys, at_home, bits, most)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return dealt.repartition("anchor", "row", "across").sortWithinPartitions("anchor", "row", "across").mapInArrow(compare, "a long, b long")


def _groups(batches):
    """Sorted rows in runs of whole groups: number of the group, home flag, fingerprint."""
    rest = None
    for batch in batches:
        rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        keys = np.stack([rest.column(c).to_numpy() for c in ("anchor", "row", "across")])
        new = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if len(new):
            yield _numbered(rest.slice(0, new[-1]))
            rest = rest.slice(new[-1])
    if rest is not None and len(rest):
        yield _numbered(rest)


def _numbered(table: pa.Table):
    keys = np.stack([table.column(c).to_numpy() for c in ("anchor", "row", "across")])
    group = np.concatenate(([0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))))
    return group, table.column("home").to_numpy(), table.column("bits").to_numpy().view(np.uint64)


def _forests(group: np.ndarray, at_home: np.ndarray, bits: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups of few homes are compared all at once, one home beside every visitor of its group; others one by one."""
    edges = np.concatenate((np.flatnonzero(np.diff(group, prepend=-1)), [len(group)]))
    a, b = [], []
    homes_at = np.flatnonzero(at_home)
    guests_at = np.flatnonzero(~at_home)
    homes_in = np.searchsorted(homes_at, edges)
    guests_in = np.searchsorted(guests_at, edges)
    n_homes, n_guests = np.diff(homes_in), np.diff(guests_in)
    small = n_homes * n_guests <= 4096
    of_home = group[homes_at]
    few = np.flatnonzero(small[of_home])
    for k in range(0, len(few), 4096):
        some = few[k : k + 4096]
        counts = n_guests[of_home[some]]
        x = np.repeat(bits[homes_at[some]], counts)
        y = bits[guests_at[texts.within(guests_in[of_home[some]], counts)]]
        near = (np.bitwise_count(x ^ y) <= most) & (x != y)
        a.append(x[near])
        b.append(y[near])
    for g in np.flatnonzero(~small):
        x, y = forest(bits[homes_at[homes_in[g] : homes_in[g + 1]]], bits[guests_at[guests_in[g] : guests_in[g + 1]]], most)
        a.append(x)
        b.append(y)
    return (np.concatenate(a), np.concatenate(b)) if a else (bits[:0], bits[:0])


def _named(marked: DataFrame, most: int) -> DataFrame:
    """``bits``, root (a fingerprint of the component) and component_id."""
    least = materialize(marked.groupBy("bits").agg(F.min("id").alias("least")), "distinct")
    found = components(links(least, most)).toDF("bits", "root")
    names = materialize(least.join(found, "bits", "left").select("bits", F.coalesce("root", "bits").alias("root"), "least"), "roots")
    name_of = materialize(names.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    return materialize(names.join(name_of, "root").select("bits", "root", "component_id"), "named")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, most: int = MOST
) -> DataFrame:
    """``id_col``, fingerprint (16 lower-case hex digits), component_id (smallest id reachable) of each row."""
    marked = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return marked.join(_named(marked, most), "bits").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, most: int = MOST
) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: that of the smallest id.

    A row without an id stays only if none of its group has one. Rows of one id and text are one row.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    first = F.struct(F.col("id").isNull(), "id", "k1", "k2")
    stay = (
        marked.join(_named(marked, most).select("bits", "root"), "bits")
        .groupBy("root")
        .agg(F.min(first).alias("stay"))
        .select(F.col("stay.id").alias("id"), F.col("stay.k1").alias("k1"), F.col("stay.k2").alias("k2"))
        .distinct()
    )
    names = fresh(docs, "k1", "k2")
    keyed = docs.withColumns(dict(zip(names, text_key(quoted(text_col)))))
    stay = stay.toDF(*[fresh(keyed, f"stay_{c}")[0] for c in ("id", "k1", "k2")])
    same = quoted(id_col).eqNullSafe(F.col(stay.columns[0]))
    for a, b in zip(names, stay.columns[1:]):
        same &= F.col(a) == F.col(b)
    return keyed.join(stay, same, "left_semi").dropDuplicates([id_col, *names]).drop(*names)
