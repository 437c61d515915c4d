"""Spelling variants: words one code point apart, and the frequent word that a rare one is a variant of.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF; only A-Z are lower-cased. Two words are near if one inserted, deleted or
replaced code point turns one into the other. The form of a word is its near word of largest count (of
equal counts the smallest in code-point order), if that count is ``TIMES`` its own; the root is where forms lead.

Method: a frequency-vector trie. Letters are dealt to ``GROUPS`` groups by their frequency in the vocabulary. A word's vector counts
its letters by group, and the trie has a level for each group: a path is a vector. One edit adds a letter, takes one, or does
both, so a depth-first search may go to a child with one letter more once (the surplus) and with one less once (the deficit).
All words of a task search together: a node is visited once, by the words that can reach it, until words and leaves
left are few. Leaf words that share the first or the last half with the searching word are verified letter by letter.

The trie is dealt over tasks by its upper levels, as many as it takes until no subtree has more than ``WORDS`` words (a subtree of
equal vectors may; it is cut into blocks). A word goes to the subtrees it can reach; of two subtrees that reach each other,
the lesser's words go to the greater one, so that a pair is found once. Searching words come in turns of ``ASKED``. So
no task holds more, whatever the vocabulary; no pair is written, only a word's number of near words and the best one, per subtree.

Nulls and ties: a null text has no words, a null id is the empty text. Rows count as they are, repeated ones too. Texts and
words may be of any length; texts are read a slice at a time. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import texts
from millrace.llm.rows import quoted
from millrace.scratch import materialize

LENGTH = 7
LEAST = 2
TIMES = 10
GROUPS = 16
WORDS = 1 << 16
ASKED = 1 << 18

#: Pairs of words and leaves that are compared by halves at once, without going down further.
LEAF = 1 << 16

#: Words of more code points are verified one by one.
WIDE = 48

#: Bytes of texts looked at together, and runs counted together.
SLICE = 2_000_000
RUNS = 400_000

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _crc_steps() -> np.ndarray:
    """What a byte does to a CRC-32: eight divisions by the reversed polynomial."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    return step


_CRC = _crc_steps()


def _inside(content: np.ndarray) -> np.ndarray:
    """Bytes of runs. In UTF-8, 0xC3 begins U+00C0 to U+00FF and nothing else."""
    inside = _LETTER[content]
    lead = content == 0xC3
    inside |= lead
    inside[1:] |= lead[:-1]
    return inside


def _slices(content: np.ndarray) -> Iterator[tuple[int, int]]:
    """A long text in slices that end outside of runs."""
    low = 0
    while low < len(content):
        high = min(len(content), low + SLICE)
        while high < len(content):
            outside = np.flatnonzero(~_inside(content[high - 1 : high + 4096])[1:])
            if len(outside):
                high += int(outside[0])
                break
            high = min(len(content), high + 4095)
        yield low, high
        low = high


def _crc(before: np.ndarray, content: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of the runs, each after what gave ``before``; a byte of all runs at a time."""
    order = np.argsort(-size, kind="stable")
    out, begin, size = before[order], begin[order], size[order]
    long = int(np.searchsorted(-size, -256, side="left"))
    for k in range(long):
        out[k] = zlib.crc32(content[begin[k] : begin[k] + size[k]].tobytes(), int(out[k]))
    state = out[long:] ^ np.uint32(0xFFFFFFFF)
    begin, size = begin[long:], size[long:]
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k, side="left"))
        now = state[:n]
        state[:n] = _CRC[(now ^ content[begin[:n] + k]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    out[long:] = state ^ np.uint32(0xFFFFFFFF)
    found = np.empty_like(out)
    found[order] = out
    return found


def runs(ids: list[str], content: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, garble: int | None) -> pa.Array:
    """The lower-cased runs of at least ``length`` code points, one code point gone where ``garble`` says so."""
    content = texts.LOWER[content]
    inside = _inside(content)
    edge = np.zeros(len(content) + 1, dtype=bool)
    edge[starts] = edge[ends] = True
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    begin = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    points = texts.running((content & 0xC0) != 0x80)
    n = points[end] - points[begin]
    some = n >= length
    begin, end, n = begin[some], end[some], n[some]
    gone = np.zeros(len(n), np.int64)
    keep = np.zeros(len(content) + 1, np.int8)
    if garble:
        told = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
        h = _crc(told[np.searchsorted(ends, begin, side="right")], content, begin, end - begin).astype(np.int64)
        hit = (h % garble == 0) & (n > length)
        some = hit | (h % garble != 0)
        begin, end, n, h, hit = begin[some], end[some], n[some], h[some], hit[some]
        place = np.flatnonzero((content & 0xC0) != 0x80)
        at = points[begin[hit]] + h[hit] % n[hit]
        a = place[at]
        b = np.minimum(np.append(place, len(content))[at + 1], end[hit])
        gone = np.zeros(len(n), np.int64)
        gone[hit] = b - a
        keep[a] -= 1
        keep[b] += 1
    keep[begin] += 1
    keep[end] -= 1
    data = content[np.cumsum(keep[:-1]) > 0]
    offsets = texts.running(end - begin - gone).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, least: int = LEAST, garble: int | None = None
) -> DataFrame:
    """``word`` and ``n``: words of at least ``length`` code points that occur ``least`` times or more.

    With ``garble``, a run loses a code point where the CRC-32 of ``<id>:<run>`` is a multiple of it: the one whose number is that CRC-32
    modulo the run's length. That puts errors whose right form is known into clean texts.
    """
    rows = docs.select(F.coalesce(quoted(id_col).cast("string"), F.lit("")).alias("id"), quoted(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        for some in _found(batches):
            held.append(some)
            if sum(map(len, held)) >= RUNS:
                yield _counted(held)
                held = []
        if held:
            yield _counted(held)

    def _found(batches):
        for part in texts.pieces(batches, "text", SLICE):
            starts, ends, content = texts.spans(part.column("text"))
            ids = part.column("id").to_pylist()
            if len(part) > 1:
                yield runs(ids, content, starts, ends, length, garble)
                continue
            for low, high in _slices(content):
                yield runs(ids, content[low:high], np.array([0]), np.array([high - low]), length, garble)

    counts = rows.where(F.octet_length("text") >= length).mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counted(held: list[pa.Array]) -> pa.RecordBatch:
    counts = pc.value_counts(pa.concat_arrays(held))
    return pa.RecordBatch.from_arrays([counts.field(0), counts.field(1)], names=["word", "n"])


class Letters:
    """Words as code points, one after the other, and their vectors."""

    def __init__(self, words: pa.Array, group: np.ndarray):
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks() if words.num_chunks != 1 else words.chunk(0)
        self.points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
        self.size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        self.end = np.cumsum(self.size)
        self.begin = self.end - self.size
        self.group = group

    def vectors(self) -> np.ndarray:
        dealt = np.where(self.points < len(self.group), self.group[np.minimum(self.points, len(self.group) - 1)], self.points % GROUPS)
        at = np.repeat(np.arange(len(self.size)), self.size) * GROUPS + dealt
        return np.bincount(at, minlength=len(self.size) * GROUPS).astype(np.int32).reshape(-1, GROUPS)

    def halves(self) -> list[np.ndarray]:
        """Hashes of the first and the last half, of the word and of what it would be if it had one letter less.

        Of two near words the shorter one's first or last half is in both, where the longer one is cut at the same place.
        """
        sums, out = texts.prefix_sums(self.points.astype(np.uint64) + np.uint64(1)), []
        for size in (self.size, self.size - 1):
            half, tag = size // 2, texts.mixed(size.astype(np.uint64))
            out.append(texts.hashes(sums, self.begin, self.begin + half) ^ tag)
            out.append(texts.hashes(sums, self.end - (size - half), self.end) + tag)
        return out

    def aligned(self) -> tuple[np.ndarray, np.ndarray]:
        """The first ``WIDE`` code points from the left and from the right, filled with zeros."""
        size = np.minimum(self.size, WIDE)
        row, column = np.repeat(np.arange(len(size)), size), texts.within(np.zeros(len(size), np.int64), size)
        left, right = np.zeros((2, len(size), min(WIDE, int(size.max(initial=0)))), np.uint32)
        left[row, column] = self.points[texts.within(self.begin, size)]
        right[row, column] = self.points[np.repeat(self.end, size) - 1 - column]
        return left, right

    def text(self, k: int) -> np.ndarray:
        return self.points[self.begin[k] : self.end[k]]


def _alike(left: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Length of the common beginning."""
    same = left == other
    return np.where(same.all(axis=1), left.shape[1], same.argmin(axis=1))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    apart = np.flatnonzero(a[:n] != b[:n])
    return int(apart[0]) if len(apart) else n


def near(words: Letters, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Is word a[i] one edit from word b[i]? What they share at both ends leaves out one code point."""
    left, right = words.aligned()
    out = np.zeros(len(a), dtype=bool)
    most, least = np.maximum(words.size[a], words.size[b]), np.minimum(words.size[a], words.size[b])
    short = (most <= WIDE) & (most - least <= 1)
    for low in range(0, len(a), 1 << 16):
        k = low + np.flatnonzero(short[low : low + (1 << 16)])
        head, tail = _alike(left[a[k]], left[b[k]]), _alike(right[a[k]], right[b[k]])
        head, tail = np.minimum(head, least[k]), np.minimum(tail, least[k])
        out[k] = (head + tail >= most[k] - 1) & (head < most[k])
    for k in np.flatnonzero((most > WIDE) & (most - least <= 1)):
        one, other = words.text(a[k]), words.text(b[k])
        head, tail = _common(one, other), _common(one[::-1], other[::-1])
        out[k] = head + tail >= most[k] - 1 and head < most[k]
    return out


def search(leaves: np.ndarray, asked: np.ndarray, budget: np.ndarray, level: int, close, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (leaf, asking word) that the depth-first search meets and ``close`` keeps.

    ``leaves`` are vectors in order, so a node is a range of them. ``budget`` says of each asking word whether its surplus
    and its deficit are left below the first ``level`` groups. Where no more than ``leaf`` pairs are left, nobody goes down further.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def visit(level: int, low: int, high: int, who: np.ndarray, more: np.ndarray, less: np.ndarray) -> None:
        if (high - low) * len(who) <= leaf or level == GROUPS:
            for first in range(low, high, step := max(1, 16 * leaf // max(1, len(who)))):
                a, b = close(first, min(high, first + step), who)
                found.append((a, who[b]))
            return
        counts = leaves[low:high, level]
        cuts = np.concatenate(([0], np.flatnonzero(counts[1:] != counts[:-1]) + 1, [high - low]))
        own = asked[who, level]
        for a, b in zip(cuts[:-1], cuts[1:]):
            apart = counts[a] - own
            go = np.flatnonzero((apart == 0) | ((apart == 1) & more) | ((apart == -1) & less))
            if len(go):
                apart = apart[go]
                visit(level + 1, low + a, low + b, who[go], more[go] & (apart != 1), less[go] & (apart != -1))

    if len(leaves) and len(asked):
        visit(level, 0, len(leaves), np.arange(len(asked)), budget[0], budget[1])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


_NEAR = {"word": pa.string(), "n_near": pa.int64(), "best_n": pa.int64(), "best": pa.string()}


def _subtree(group: np.ndarray, prefix: np.ndarray, here: pa.Table, asking: pa.Table, leaf: int) -> pa.Table:
    """Of the words of a subtree and of those that search it: how many near ones were met, and the best of them."""
    m, top = len(here), len(prefix)
    words = pa.concat_arrays([c for t in (here, asking) for c in t.column("word").chunks]) if m and len(asking) else None
    if words is None:
        return pa.table({c: pa.array([], kind) for c, kind in _NEAR.items()})
    n = np.concatenate([t.column("n").to_numpy() for t in (here, asking)])
    letters = Letters(words, group)
    vectors = letters.vectors()
    order = np.lexsort(vectors[:m, ::-1].T)
    apart = prefix - vectors[m:, :top]
    halves = letters.halves()
    ours, theirs = [x[:m][order] for x in halves], [x[m:] for x in halves]

    def close(low: int, high: int, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        meet = np.zeros((high - low, len(who)), dtype=bool)
        for k in (0, 1):
            whole, less = ours[k][low:high, None], ours[k + 2][low:high, None]
            asked, asked_less = theirs[k][who], theirs[k + 2][who]
            meet |= (whole == asked) | (less == asked) | (whole == asked_less)
        return (found := np.nonzero(meet))[0] + low, found[1]

    a, b = search(vectors[:m][order], vectors[m:], np.array([(apart == 1).sum(axis=1) == 0, (apart == -1).sum(axis=1) == 0]), top, close, leaf)
    a, b = order[a], b + m
    ok = near(letters, a, b)
    a, b = a[ok], b[ok]
    # Words of the subtree search it themselves; those from elsewhere are met here only.
    foreign = (apart != 0).any(axis=1)[b - m]
    one, other = np.concatenate((b, a[foreign])), np.concatenate((a, b[foreign]))
    rank = np.empty(len(n), np.int64)
    rank[pc.sort_indices(words).to_numpy()] = np.arange(len(n))
    order = np.lexsort((rank[other], -n[other], one))
    one, other = one[order], other[order]
    first = np.flatnonzero(np.concatenate(([True], one[1:] != one[:-1]))) if len(one) else np.zeros(0, np.int64)
    return pa.table(
        {
            "word": words.take(pa.array(one[first])),
            "n_near": np.diff(np.append(first, len(one))),
            "best_n": n[other[first]],
            "best": words.take(pa.array(other[first])),
        }
    )


def _keys(vectors: np.ndarray) -> pa.Array:
    """The counts of the upper levels as bytes."""
    n, wide = len(vectors), 4 * vectors.shape[1]
    offsets = (np.arange(n + 1) * wide).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(vectors, ">i4").tobytes())])


def _reach(top: int) -> list[np.ndarray]:
    """Steps to the subtrees that words go to: none, and those whose first change is a surplus."""
    steps = [np.zeros(top, np.int32)]
    for j in range(top):
        for k in (None, *range(j + 1, top)):
            steps.append(np.zeros(top, np.int32))
            steps[-1][j] = 1
            if k is not None:
                steps[-1][k] = -1
    return steps


def _dealt(rows: DataFrame, group: np.ndarray, top: int, everywhere: bool) -> DataFrame:
    """``key``, word and n: the word's own subtree or, ``everywhere``, all that it goes to."""
    steps = _reach(top) if everywhere else _reach(0)

    def deal(batches):
        for batch in batches:
            if not len(batch):
                continue
            vectors = Letters(batch.column("word"), group).vectors()[:, :top]
            for step in steps:
                to = vectors + step if len(step) else vectors
                some = np.flatnonzero((to >= 0).all(axis=1))
                part = batch.take(pa.array(some))
                yield pa.RecordBatch.from_arrays([_keys(to[some]), part.column("word"), part.column("n")], names=["key", "word", "n"])

    return rows.mapInArrow(deal, "key binary, word string, n long")


def _grouping(words: DataFrame) -> np.ndarray:
    """Group of each letter: in order of frequency they are dealt to groups to and fro."""

    def count(batches):
        for batch in batches:
            points, n = np.unique(Letters(batch.column("word"), np.zeros(256, np.int64)).points, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(points.astype(np.int64)), pa.array(n)], names=["point", "n"])

    group = np.arange(256) % GROUPS
    counts = words.mapInArrow(count, "point long, n long").where("point < 256").groupBy("point").agg(F.sum("n").alias("n"))
    for k, row in enumerate(counts.orderBy(F.desc("n"), "point").collect()):  # 256 at most
        lap, at = divmod(k, GROUPS)
        group[row["point"]] = GROUPS - 1 - at if lap % 2 else at
    return group


def _levels(words: DataFrame, group: np.ndarray) -> tuple[int, DataFrame]:
    """How many levels deal the trie over tasks; ``key``, blocks and turns of the subtrees below them."""

    def count(batches):
        for batch in batches:
            if len(batch):
                keys = pc.value_counts(_keys(Letters(batch.column("word"), group).vectors()))
                yield pa.RecordBatch.from_arrays([keys.field(0), keys.field(1)], names=["vector", "n"])

    whole = words.mapInArrow(count, "vector binary, n long").groupBy("vector").agg(F.sum("n").alias("n"))
    whole = materialize(whole, "paths")
    for top in range(GROUPS + 1):
        sizes = whole.groupBy(F.substring("vector", 1, 4 * top).alias("key")).agg(F.sum("n").alias("n"))
        if top == GROUPS or (sizes.agg(F.max("n")).first()[0] or 0) <= WORDS:
            break
    sizes = materialize(sizes, "subtrees")

    def reach(batches):
        for batch in batches:
            own = np.frombuffer(b"".join(batch.column("key").to_pylist()), ">i4").astype(np.int32).reshape(len(batch), top)
            for step in _reach(top):
                some = np.flatnonzero((own + step >= 0).all(axis=1))
                part = batch.take(pa.array(some))
                yield pa.RecordBatch.from_arrays([_keys((own + step)[some]), part.column("n")], names=["key", "n"])

    asking = sizes.mapInArrow(reach, "key binary, n long").groupBy("key").agg(F.sum("n").alias("asking"))
    parts = {"blocks": F.ceil(F.col("n") / WORDS), "turns": F.ceil(F.col("asking") / ASKED)}
    return top, materialize(sizes.join(asking, "key").select("key", *[v.alias(c) for c, v in parts.items()]), "parts")


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near and form_n of each row of ``words`` (word, n), which holds a word once."""
    words, leaf = materialize(words.select("word", "n"), "words"), LEAF
    group = _grouping(words)
    top, parts = _levels(words, group)

    def spread(rows: DataFrame, own: str, other: str, each: str, of: str) -> DataFrame:
        """Rows of a part by hash, copied to each of the other side's parts."""
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
        return rows.join(parts, "key").select("key", F.pmod(F.xxhash64("word"), F.col(each)).alias(own), copies.alias(other), "word", "n")

    here = spread(_dealt(words, group, top, False), "block", "turn", "blocks", "turns").select("key", "block", "turn", "word", "n")
    asking = spread(_dealt(words, group, top, True), "turn", "block", "turns", "blocks").select("key", "block", "turn", "word", "n")

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _subtree(group, np.frombuffer(key[0].as_py(), ">i4").astype(np.int32), left, right, leaf)

    keys = ("key", "block", "turn")
    met = here.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(meet, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best")))
    near = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    form = F.when(-F.col("best.minus") >= times * F.col("n"), F.col("best.best"))
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), form.alias("form"), (-F.col("best.minus")).alias("best_n")
    )
    found = materialize(found, "forms")
    roots = _roots(found.where("form is not null").select("word", "form"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n")
    )


def _roots(links: DataFrame) -> DataFrame:
    """word and root: forms are followed at twice the pace each round. Counts grow tenfold with a step, so rounds are few."""
    now = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = now.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        step = materialize(step, "roots")
        if step.where("moved").isEmpty():
            return now
        now = step.select("word", "root")
