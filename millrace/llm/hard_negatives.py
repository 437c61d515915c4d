"""Hard negatives by a vertical scan: per anchor and positive, the best rows of other labels whose score lies in a window.

Components are taken as integers, ``floor(SCALE * x)``; a score is the integer inner product with the anchor, higher ones first,
ties by smaller id. An anchor's positives are its best ``POSITIVES`` other rows of the same label. Per positive of score p the
negatives are the best ``NEGATIVES`` rows of other labels whose score s satisfies ``LOW * p <= 100 * s <= HIGH * p``.

Method (BOND): a block of rows is held by dimension. An anchor reads the dimensions in descending order of its own magnitude, ``STEP`` at a
time, and adds them to the partial scores. What the dimensions not read can still add lies between sums of their least and
largest products, from each dimension's minimum and maximum in the block; so every row has a lower and an upper bound. Rows whose
bounds rule them out leave the candidate bitmap: for positives, those below the k-th largest lower bound; for negatives, those
that meet no window, or that are below the k-th largest lower bound of the rows surely within. When all dimensions are read, scores are
exact, and so are the windows. Nothing is approximate and nothing is capped.

Rows are dealt into blocks of about ``BYTES``: for the positives by label (small labels share a block, a label that holds a third of
all rows has many), for the negatives evenly. Anchors meet them in turns of about ``TURN``: the blocks of their label first, then, with the
windows that follow, all blocks. A block returns a few rows per anchor, which windows over anchors merge in two stages.

Nulls and ties: rows with a null label, a null vector, or any null or non-finite component (also once scaled) take no part. Vectors of different lengths
have no inner product, so rows meet those of their own length; empty ones score 0. Rows that share an id are rows of their own:
each is an anchor, and the other one may be its positive. A row without id is no anchor, and comes after others of its score. Sums are exact
up to 64 bits (in doubles as long as these are exact, then in integers); beyond that, in integers of any size, and scores are held to the
range of a long. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import quoted
from millrace.scratch import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
STEP = 8
BYTES = 8_000_000
TURN = 16_384
SALTS = 16

_LAST = (1 << 63) - 1


def usable(rows: DataFrame, label: Column, id_col: str, vector_col: str) -> DataFrame:
    """row (a number of its own), id, label, size and vector (doubles of whole value) of the rows that take part."""
    vectors = rows.select(quoted(id_col).cast("long").alias("id"), label.cast("long").alias("label"), quoted(vector_col).cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * F.lit(float(SCALE))) < float("inf")))
    # Not Spark's floor, which gives a long. Below -2**53 and above 2**53 a double is whole already.
    scaled = F.transform("vector", lambda x: x * F.lit(float(SCALE)))
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x))
    kept = vectors.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & sound)
    return kept.select(F.monotonically_increasing_id().alias("row"), "id", "label", F.size("vector").alias("size"), whole.alias("vector"))


class Block:
    """Rows by dimension, with each dimension's least and largest value."""

    def __init__(self, table: pa.Table, size: int):
        ids, self.missing = table.column("id").fill_null(0).to_numpy(), table.column("id").is_null().to_numpy()
        keys, labels, rows = table.column("row").to_numpy(), table.column("label").to_numpy(), _matrix(table.column("vector"), size)
        order = np.lexsort((keys, ids, self.missing))  # so that a stable sort by score breaks ties by id
        self.ids, self.missing, self.keys, self.labels, rows = ids[order], self.missing[order], keys[order], labels[order], rows[order]
        self.largest = float(np.abs(rows).max(initial=0))
        self.columns = np.ascontiguousarray(rows.T)
        self.least, self.most = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else np.zeros((2, size))

    def typed(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Columns, least, most and anchor in a type that holds all sums exactly."""
        bound = self.largest * float(np.abs(anchor).max(initial=0)) * max(1, len(anchor))
        parts = (self.columns, self.least, self.most, anchor)
        if bound < 1 << 53:
            return parts
        if bound < 1 << 62:
            return tuple(x.astype(np.int64) for x in parts)
        return tuple(np.array([int(v) for v in x.ravel()], dtype=object).reshape(x.shape) for x in parts)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, settle) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``alive`` that ``settle(lower, upper)`` never ruled out, and their exact scores."""
        columns, least, most, anchor = self.typed(anchor)
        n, size = len(self.ids), len(anchor)
        order = np.argsort(-np.abs(anchor).astype(float), kind="stable")
        a = anchor[order]
        ends = np.stack((least[order] * a, most[order] * a))
        # What dimensions from d on can add: sums from the last one backwards.
        rest_low, rest_high = (np.append(np.cumsum(x[::-1])[::-1], x[:1] * 0 if size else 0) for x in (ends.min(axis=0), ends.max(axis=0)))
        sums = np.zeros(len(alive), columns.dtype)
        for d in range(0, size, STEP):
            some = order[d : d + STEP]
            part = columns[some] if len(alive) == n else columns[np.ix_(some, alive)]
            sums = sums + a[d : d + STEP] @ part
            done = min(size, d + STEP)
            keep = settle(sums + rest_low[done], sums + rest_high[done])
            if not keep.all():
                alive, sums = alive[keep], sums[keep]
            if not len(alive):
                break
        if not size:
            alive = alive[settle(sums, sums)]
        return alive, sums[: len(alive)]


def _kth(values: np.ndarray, k: int):
    """The k-th largest, None if there are fewer."""
    if len(values) < k:
        return None
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, len(values) - k)[len(values) - k]


def best(block: Block, anchor: np.ndarray, label: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows of the label in the block, best first, and their scores."""

    def settle(low, high):
        least = _kth(low, k)
        return np.ones(len(low), dtype=bool) if least is None else np.asarray(high >= least, dtype=bool)

    rows, scores = block.scan(anchor, np.flatnonzero(block.labels == label), settle)
    order = np.argsort(-scores, kind="stable")[:k]
    return rows[order], scores[order]


def within(block: Block, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (least and largest score), the k best rows of other labels in it."""

    def settle(low, high):
        keep = np.zeros(len(low), dtype=bool)
        for a, b in windows:
            meets = np.asarray((high >= a) & (low <= b), dtype=bool)
            least = _kth(low[np.asarray((low >= a) & (high <= b), dtype=bool)], k)
            keep |= meets if least is None else meets & np.asarray(high >= least, dtype=bool)
        return keep

    rows, scores = block.scan(anchor, np.flatnonzero(block.labels != label), settle)
    order = np.argsort(-scores, kind="stable")
    rows, scores = rows[order], scores[order]
    out = []
    for a, b in windows:
        some = np.flatnonzero(np.asarray((scores >= a) & (scores <= b), dtype=bool))[:k]
        out.append((rows[some], scores[some]))
    return out


def _matrix(array: pa.ChunkedArray, size: int) -> np.ndarray:
    return array.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(array), size)


def _longs(scores: list) -> pa.Array:
    return pa.array([max(-_LAST - 1, min(_LAST, int(s))) for s in scores], pa.int64())


_FOUND = "anchor long, place int, row long, id long, score long"


def _table(out: dict[str, list], block: Block) -> pa.Table:
    at = np.array(out["at"], np.int64)
    ids = pa.array(block.ids[at], pa.int64(), mask=block.missing[at])
    anchors, places = pa.array(out["anchor"], pa.int64()), pa.array(out["place"], pa.int32())
    return pa.table({"anchor": anchors, "place": places, "row": block.keys[at], "id": ids, "score": _longs(out["score"])})


def _merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best per key, with their rank. Salted first, so that no task gets what all blocks found for an anchor."""
    order = [F.desc("score"), F.col("id").asc_nulls_last(), F.col("row")]
    some = Window.partitionBy(*keys, F.pmod(F.xxhash64("row"), F.lit(SALTS))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    asks: Column,
    label: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Anchors are the rows that ``asks`` (on id) names.

    ``label`` is an expression on ``rows``, the column ``label`` if not given. Scores are those of the integer vectors.
    """
    label = quoted("label") if label is None else label
    vectors = materialize(usable(rows, label, id_col, vector_col), "vectors")
    chosen = vectors.where(asks)
    # Blocks and turns of each length of vector; blocks of each label that fills more than one.
    asking, many = F.sum(F.when(asks, 1).otherwise(0)), F.ceil(F.count(F.lit(1)) * F.greatest(F.lit(1), F.col("size")) * 8 / BYTES)
    shapes = vectors.groupBy("size").agg(many.alias("blocks"), F.ceil(asking / TURN).alias("turns"))
    shapes = materialize(shapes.where("turns > 0"), "shapes")
    big = vectors.groupBy("size", "label").agg(many.alias("parts")).where("parts > 1")
    big = materialize(big, "big")
    spread, turn = F.pmod(F.xxhash64("row"), F.col("blocks")), F.pmod(F.xxhash64("row"), F.col("turns"))
    each_turn, none = F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)), F.lit(0).cast("long")

    def labelled(some: DataFrame, part: Column) -> DataFrame:
        """lot and part of the rows' label: a hash of several small labels, or one label and ``part`` of it."""
        joined = some.join(shapes, "size").join(big, ["size", "label"], "left")
        lot = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("label"), F.col("blocks"))).otherwise(F.col("label"))
        return joined.withColumns({"lot": F.struct(F.col("parts").isNull(), lot), "part": part})

    def first(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        size, out = key[0].as_py(), {c: [] for c in ("anchor", "place", "at", "score")}
        block = Block(left, size)
        for anchor, own, vector in _asking(right, size):
            found, scores = best(block, vector, own, positives + 1)  # one more for the anchor itself
            out["at"] += found.tolist()
            out["score"] += scores.tolist()
            out["anchor"] += [anchor] * len(found)
            out["place"] += [0] * len(found)
        return _table(out, block)

    keys = ("size", "lot", "part", "turn")
    held = labelled(vectors, F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), none)).withColumn("turn", each_turn)
    asked = labelled(chosen, F.explode(F.sequence(none, F.coalesce(F.col("parts") - 1, none)))).withColumn("turn", turn)
    held, asked = (x.select(*[F.col(c).alias(c) for c in (*keys, "label", "row", "id", "vector")]) for x in (held, asked))
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(first, _FOUND)
    # Scores beyond a long are held to its range, and so are the windows of such positives.
    best_of = _merged(found.where("row <> anchor"), ["anchor"], positives)
    score = F.col("score").cast("decimal(38,0)")
    windows = {"least": F.ceil(score * low / 100), "most": F.floor(score * high / 100)}
    best_of = best_of.select("anchor", F.col("rank").alias("place"), "id", "score", *[v.cast("decimal(38,0)").alias(c) for c, v in windows.items()])
    best_of = materialize(best_of, "positives")
    # A positive of negative score has an empty window: half of it is more than 95 hundredths.
    open_ = best_of.where("least <= most").groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("place", "least", "most")).alias("windows"))

    def second(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        size, out = key[0].as_py(), {c: [] for c in ("anchor", "place", "at", "score")}
        block = Block(left, size)
        for (anchor, own, vector), asked in zip(_asking(right, size), right.column("windows").to_pylist()):
            found = within(block, vector, own, [(int(w["least"]), int(w["most"])) for w in asked], negatives)
            for w, (at, scores) in zip(asked, found):
                out["at"] += at.tolist()
                out["score"] += scores.tolist()
                out["anchor"] += [anchor] * len(at)
                out["place"] += [w["place"]] * len(at)
        return _table(out, block)

    keys = ("size", "block", "turn")
    held = vectors.join(shapes, "size").withColumn("block", spread).withColumn("turn", each_turn).select(*keys, "label", "row", "id", "vector")
    asked = chosen.join(open_, "row").join(shapes, "size").withColumn("block", F.explode(F.sequence(none, F.col("blocks") - 1)))
    asked = asked.withColumn("turn", turn).select(*[F.col(c).alias(c) for c in (*keys, "label", "row", "vector", "windows")])
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(second, _FOUND)
    negative = _merged(found, ["anchor", "place"], negatives).select("anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = chosen.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    positive = best_of.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        negative.join(positive, ["anchor", "place"])
        .join(ids, "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


def _asking(table: pa.Table, size: int):
    """row, label and vector of each anchor."""
    vectors = _matrix(table.column("vector"), size) if len(table) else ()
    return zip(table.column("row").to_pylist(), table.column("label").to_pylist(), vectors)
