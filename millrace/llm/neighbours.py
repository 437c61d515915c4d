"""Approximate nearest neighbours by inner product: an adaptive scan of dimensions within probed lists.

Vectors get one more dimension that makes all of them equally long, so that the largest inner product with
a query scaled to length one is the smallest distance. They are rotated at random; then the first d of D dimensions are a
random sample of a vector's length. Lists hold the rows, each that of the nearest centre, as many lists as the square root of
the rows (``LISTS`` at most); a query looks at the lists of the nearest centres. In a list, distances are summed block by block of ``COLUMNS`` dimensions. After each block a
candidate is given up if the test says that its whole distance exceeds that of the k-th best so far:

    partial * D / d > best * (1 + ERROR / sqrt(d)) ** 2

What survives is scored exactly, in double precision, on the vectors as given.

The centres are fitted on a bounded sample (the rows of the smallest hash, ``SAMPLE`` or ``SHARE`` for each list); every row is
in a list. How many lists a query looks at is measured: ``TRIALS`` queries are compared with every row, and so many lists are
probed that ``AIM`` of their nearest rows lie in them. Vectors with hardly any clusters need most of the lists, others few.
Tests measure the recall against brute force. A list is cut into blocks of some ``ROWS`` rows and some ``QUERIES`` of the
queries that look at it, so that neither a crowded list nor many equal vectors gather in a task.

Nulls and ties: vectors that are null, zero, or hold null or non-finite components take no part. Rows are told apart by a number
of their own: of rows that share an id each is a query and a candidate, of the others too. A row without an id is no query; as
a candidate it comes after others of its score. Vectors of different lengths have no inner product, so each length is searched among its
own, with centres of its own. Equal scores rank by id. A query with fewer candidates gets all of those found.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import quoted
from millrace.scratch import materialize

LISTS = 4_096
TRIALS = 64
AIM = 0.965
COLUMNS = 16
ERROR = 2.1
SAMPLE = 16_384
SHARE = 32
ROWS = 16_384
QUERIES = 4_096
SEED = 11


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``row`` (a number of its own), ``id``, ``size`` and ``vector`` (floats if they are given so, else doubles) of the rows that take part."""
    given = rows.select(quoted(vector_col)).schema[0].dataType.simpleString()
    kind = given if given == "array<float>" else "array<double>"
    vectors = rows.select(quoted(id_col).alias("id"), quoted(vector_col).cast(kind).alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = vectors.where(sound & F.exists("vector", lambda x: x != 0))
    return vectors.select(F.monotonically_increasing_id().alias("row"), "id", F.size("vector").alias("size"), "vector")


def _matrix(array: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1).astype(np.float64)


class Space:
    """The longest length, the rotation and the centres; of a size that depends on the dimensions only."""

    def __init__(self, longest: float, dimensions: int):
        self.longest = longest
        rng = np.random.default_rng(SEED)
        self.rotation = np.linalg.qr(rng.normal(size=(dimensions + 1, dimensions + 1)))[0]
        self.centres = np.zeros((0, dimensions + 1))

    def centred(self, sample: np.ndarray, lists: int) -> np.ndarray:
        """Centres of the sample: ten rounds of moving each to the mean of the points nearest to it."""
        points = self.place(sample)
        centres = np.unique(points, axis=0)
        centres = centres[np.random.default_rng(SEED).permutation(len(centres))[:lists]]
        for _ in range(10):
            nearest = self.nearest(points, centres)
            order = np.argsort(nearest, kind="stable")
            held, first, counts = np.unique(nearest[order], return_index=True, return_counts=True)
            centres[held] = np.add.reduceat(points[order], first, axis=0) / counts[:, None]
        return centres

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """Rows: equally long, then rotated."""
        rest = np.sqrt(np.maximum(0, 1 - (vectors**2).sum(axis=1) / self.longest**2))
        return np.column_stack((vectors / self.longest, rest)) @ self.rotation

    def ask(self, vectors: np.ndarray) -> np.ndarray:
        """Queries: of length one, nothing in the further dimension, rotated."""
        unit = vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]
        return np.column_stack((unit, np.zeros(len(vectors)))) @ self.rotation

    @staticmethod
    def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        half = (centres**2).sum(axis=1) / 2
        parts = [(points[k : k + 1024] @ centres.T - half).argmax(axis=1) for k in range(0, len(points), 1024)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def probes(self, points: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` lists of the nearest centres of each point, the nearest first."""
        half = (self.centres**2).sum(axis=1) / 2
        parts = [np.argsort(half - points[k : k + 1024] @ self.centres.T, axis=1, kind="stable")[:, :n] for k in range(0, len(points), 1024)]
        return np.concatenate(parts)


def scan(space: Space, ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """The k best rows of a list block for each query: index of the query, id, score."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    points, asked = space.place(rows).astype(np.float32), space.ask(queries).astype(np.float32)
    size = points.shape[1]
    norms = np.sqrt((queries**2).sum(axis=1)) * space.longest
    best = np.full((len(queries), k), -np.inf)
    best_id = np.zeros((len(queries), k), ids.dtype)
    who, step = np.arange(len(queries)), 512
    for first in range(0, len(ids), step):
        block = points[first : first + step]
        # Distances on the sphere of the longest row: 2 - 2 <q, x>.
        limit = np.where(np.isfinite(best[:, -1]), 2 - 2 * best[:, -1] / norms, np.inf).astype(np.float32)
        sums = np.zeros((len(queries), len(block)), np.float32)
        a = b = None  # pairs that are left, once they are few
        for low in range(0, size, COLUMNS):
            high = min(size, low + COLUMNS)
            # The last block leaves no guess: only rounding is allowed for.
            slack = (1 + ERROR / math.sqrt(high)) ** 2 * high / size if high < size else 1 + 1e-4
            q, x = asked[:, low:high], block[:, low:high]
            if a is None:
                sums += (q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1)[None, :] - 2 * (q @ x.T)
                if high == size and len(block) > k + 1:
                    # Beyond the k best of the block, one more for the query's own row, none can be among the k best of all.
                    limit = np.minimum(limit, np.partition(sums, k, axis=1)[:, k])
                alive = sums <= (limit * slack + 1e-4)[:, None]
                if high == size or alive.sum() * 32 < alive.size:
                    a, b = np.nonzero(alive)
                    sums = sums[a, b]
            else:
                sums = sums + ((q[a] - x[b]) ** 2).sum(axis=1)
                alive = sums <= limit[a] * slack + 1e-4
                a, b, sums = a[alive], b[alive], sums[alive]
        b = b + first
        other = ids[b] != query_ids[a]
        a, b = a[other], b[other]
        scores = np.empty(len(a))
        for low in range(0, len(a), 65_536):
            some = slice(low, low + 65_536)
            scores[some] = (queries[a[some]] * rows[b[some]]).sum(axis=1)
        alive = scores >= best[a, -1]
        a, b, scores = a[alive], b[alive], scores[alive]
        if not len(a):
            continue
        held = np.isfinite(best)
        all_a = np.concatenate((np.repeat(who, held.sum(axis=1)), a))
        all_id = np.concatenate((best_id[held], ids[b]))
        all_score = np.concatenate((best[held], scores))
        sort = np.lexsort((all_id, -all_score, all_a))
        all_a, all_id, all_score = all_a[sort], all_id[sort], all_score[sort]
        place = np.arange(len(all_a)) - np.searchsorted(all_a, all_a)
        keep = place < k
        best = np.full_like(best, -np.inf)
        best[all_a[keep], place[keep]] = all_score[keep]
        best_id[all_a[keep], place[keep]] = all_id[keep]
    found, place = np.nonzero(np.isfinite(best))
    return found, best_id[found, place], best[found, place]


def fit(vectors: DataFrame, lists: int | None = None, sample: int = SAMPLE) -> Space | None:
    """Centres from the sample, found by one task; None if no vector takes part."""
    square = F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    about = vectors.agg(square.alias("square"), F.max(F.size("vector")).alias("size"), F.count(F.lit(1)).alias("rows")).first()
    if about["square"] is None:
        return None
    longest, size = math.sqrt(about["square"]), about["size"]
    lists = lists or min(LISTS, math.ceil(math.sqrt(about["rows"])))
    sample = max(sample, SHARE * lists)
    chosen = vectors.orderBy(F.xxhash64("id"), "id", "row").limit(sample).repartition(1)

    def centre(batches):
        found = list(batches)
        if found:
            points = np.concatenate([np.stack(x["vector"].to_numpy()) for x in found])
            yield pd.DataFrame({"centre": list(Space(longest, size).centred(points, lists))})

    space = Space(longest, size)
    space.centres = np.array([r.centre for r in chosen.mapInPandas(centre, "centre array<double>").collect()])
    return space


def measured(listed: DataFrame, asks: Column, shared: Broadcast, k: int) -> int:
    """So many lists that ``AIM`` of the ``k`` nearest rows of ``TRIALS`` queries, found among all rows, lie in them."""
    tried = listed.where(asks).orderBy(F.xxhash64("id", F.lit(SEED)), "id", "row").limit(TRIALS).select("row", "vector").collect()
    if not tried:
        return 1
    own, queries = np.array([r["row"] for r in tried]), np.array([r["vector"] for r in tried])

    def best(batches):
        space = shared.value
        turns = np.argsort(space.probes(space.ask(queries), len(space.centres)), axis=1)
        for batch in batches:
            scores = queries @ _matrix(batch.column("vector")).T if len(batch) else np.zeros((len(queries), 0))
            scores[own[:, None] == batch.column("row").to_numpy()[None, :]] = -np.inf
            at = np.argpartition(-scores, k, axis=1)[:, :k] if scores.shape[1] > k else np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
            trial = np.repeat(np.arange(len(queries)), at.shape[1])
            at = at.ravel()
            score, turn = scores[trial, at], turns[trial, batch.column("list").to_numpy()[at]]
            held = np.isfinite(score)
            columns = [trial[held].astype(np.int32), score[held], turn[held].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["trial", "score", "turn"])

    order = Window.partitionBy("trial").orderBy(F.desc("score"), "turn")
    near = listed.select("row", "vector", "list").mapInArrow(best, "trial int, score double, turn int")
    turns = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).groupBy("turn").count().orderBy("turn").collect()
    held, wanted = 0, AIM * sum(r["count"] for r in turns)
    for r in turns:
        held += r["count"]
        if held >= wanted:
            return r["turn"] + 1
    return 1


def search(
    rows: DataFrame,
    asks: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    lists: int | None = None,
    probes: int | None = None,
) -> DataFrame:
    """query_id, rank (from 1), ``id_col`` and score: the k nearest rows found of each row that ``asks`` (on id) names."""
    vectors = materialize(usable(rows, id_col, vector_col), "vectors")
    sizes = [r["size"] for r in vectors.where(asks).select("size").distinct().orderBy("size").collect()]
    kind = vectors.schema["id"].dataType.simpleString()
    found = [_near(vectors.where(F.col("size") == size).drop("size"), asks, kind, k, lists, probes) for size in sizes or [0]]
    near = found[0]
    for more in found[1:]:
        near = near.unionByName(more)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _near(vectors: DataFrame, asks: Column, kind: str, k: int, lists: int | None, probes: int | None) -> DataFrame:
    """query, query_id, row, id and score of the best rows in each list, for vectors of one length."""
    space = fit(vectors, lists)
    floats = vectors.schema["vector"].dataType.simpleString()
    shared = vectors.sparkSession.sparkContext.broadcast(space)

    def assign(batches):
        for batch in batches:
            if len(batch):
                at = shared.value.nearest(shared.value.place(_matrix(batch.column("vector"))), shared.value.centres)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], names=["row", "id", "vector", "list"])

    def probe(batches):
        for batch in batches:
            if len(batch):
                at = shared.value.probes(shared.value.ask(_matrix(batch.column("vector"))), looks).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(at), pa.list_(pa.int32()))], names=["row", "id", "vector", "lists"])

    listed = materialize(vectors.mapInArrow(assign, f"row long, id {kind}, vector {floats}, list int"), "lists")
    looks = probes or measured(listed, asks, shared, k)
    asked = vectors.where(asks).mapInArrow(probe, f"row long, id {kind}, vector {floats}, lists array<int>")
    asked = materialize(asked, "queries")
    # Each list is cut by its own rows and its own queries; a list that no query looks at is left out.
    turns = asked.select(F.explode("lists").alias("list")).groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("turns"))
    sizes = listed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / ROWS).alias("blocks")).join(turns, "list")
    zero = F.lit(0).cast("long")
    left = (
        listed.join(sizes, "list")
        .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")))
        .select("list", "block", F.explode(F.sequence(zero, F.col("turns") - 1)).alias("turn"), "row", "id", "vector")
    )
    right = (
        asked.select("row", "id", "vector", F.explode("lists").alias("list"))
        .join(sizes, "list")
        .withColumn("turn", F.pmod(F.xxhash64("row"), F.col("turns")))
        .select("list", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"), "turn", "row", "id", "vector")
    )

    def compare(one: pa.Table, other: pa.Table) -> pa.Table:
        # By id, and rows that share one by their number: a row's place then is what breaks ties.
        one = one.sort_by([("id", "ascending"), ("row", "ascending")]) if len(one) else one
        rows, queries = one.column("row").to_numpy(), other.column("row").to_numpy()
        a = found = np.zeros(0, np.int64)
        score = np.zeros(0)
        if len(rows) and len(queries):
            sort = np.argsort(rows)
            at = sort[np.minimum(np.searchsorted(rows, queries, sorter=sort), len(rows) - 1)]
            own = np.where(rows[at] == queries, at, -1)
            a, found, score = scan(shared.value, np.arange(len(rows)), _matrix(one.column("vector")), own, _matrix(other.column("vector")), k)
        columns = [other.column("row").take(pa.array(a)), other.column("id").take(pa.array(a)), one.column("row").take(pa.array(found)), one.column("id").take(pa.array(found))]
        return pa.table([*columns, pa.array(score)], names=["query", "query_id", "row", "id", "score"])

    keys = ("list", "block", "turn")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, f"query long, query_id {kind}, row long, id {kind}, score double")
