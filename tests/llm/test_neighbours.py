import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import neighbours


def table(spark, vectors, ids=None):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x") for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, list int, vector string").repartition(4)


def exact(vectors, query, k=20):
    scores = (vectors * vectors[query]).sum(axis=1)
    scores[query] = -np.inf
    order = np.lexsort((np.arange(len(vectors)), -scores))[: min(k, len(vectors) - 1)]
    return order, scores[order]


@pytest.mark.parametrize("kind", ["round", "long", "clusters"])
def test_recall_against_brute_force(spark, kind):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 48))
    if kind == "long":
        vectors *= rng.lognormal(0, 0.5, (3000, 1))
    if kind == "clusters":
        vectors = vectors / 2 + rng.normal(size=(12, 48))[rng.integers(0, 12, 3000)]
    vectors = vectors.astype(np.float32).astype(float)
    found = neighbours.search(table(spark, vectors), F.col("id") % 20 == 0).toPandas()
    assert list(found.columns) == ["query_id", "rank", "vec_id", "score"]
    hits = 0
    for query in range(0, 3000, 20):
        own = found[found.query_id == query].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21))
        order, _ = exact(vectors, query)
        hits += len(set(order) & set(own.vec_id))
        assert (own.score.to_numpy() == (vectors[own.vec_id] * vectors[query]).sum(axis=1)).all()
        assert sorted(zip(-own.score, own.vec_id)) == list(zip(-own.score, own.vec_id))
    assert hits >= 0.9 * 150 * 20


def test_all_lists_without_tests_find_all(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(500, 20)).astype(np.float32).astype(float)
    vectors[100:400] = vectors[100]
    monkeypatch.setattr(neighbours, "ROWS", 64)
    monkeypatch.setattr(neighbours, "QUERIES", 10)
    found = neighbours.search(table(spark, vectors), F.col("id") % 20 == 0, probes=neighbours.LISTS).toPandas()
    for query in range(0, 500, 20):
        own = found[found.query_id == query].sort_values("rank")
        order, scores = exact(vectors, query)
        assert (own.score.to_numpy() == scores).all()
        if query in range(100, 400):  # hundreds of equal scores: the smallest ids
            assert own.vec_id.tolist() == order.tolist()


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], None, [0, 0], [nan, 1], [inf, 1], [None, 1], [1, 2, 3], [0.5, 1], [], [2, 2], [9, 9]]
    ids = [0, 1, 2, 3, 4, 5, 6, 20, 8, 9, None]
    found = neighbours.search(table(spark, vectors, ids), F.col("id") % 20 == 0).collect()
    wanted = [(0, 1, None, 9.0), (0, 2, 9, 2.0), (0, 3, 20, 0.5), (20, 1, None, 13.5), (20, 2, 9, 3.0), (20, 3, 0, 0.5)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == wanted


def test_lengths_are_searched_among_their_own(spark):
    vectors = [[1, 0], [1, 2, 3], [2, 0], [0, 1, 0], [3, 1], [1, 1, 1], [5]]
    found = neighbours.search(table(spark, vectors, [0, 20, 1, 2, 3, 40, 60]), F.col("id") % 20 == 0).collect()
    wanted = [(0, 1, 3, 3.0), (0, 2, 1, 2.0), (20, 1, 40, 6.0), (20, 2, 2, 2.0), (40, 1, 20, 6.0), (40, 2, 2, 1.0)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == wanted


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    found = neighbours.search(table(spark, [[1, 1], [1, 1], [3, 0], [2, 0], [2, 0]], [0, 0, 5, 5, 4]), F.col("id") % 20 == 0).collect()
    one = [(0, 1, 5, 3.0), (0, 2, 0, 2.0), (0, 3, 4, 2.0), (0, 4, 5, 2.0)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == sorted(one * 2)


def test_empty_tables_and_a_single_row(spark):
    assert neighbours.search(table(spark, []), F.col("id") % 20 == 0).count() == 0
    assert neighbours.search(table(spark, [None, [0, 0]]), F.col("id") % 20 == 0).count() == 0
    assert neighbours.search(table(spark, [[1, 2]]), F.col("id") % 20 == 0).count() == 0


def looked_at(spark, vectors):
    """Lists, and how many of them are looked at."""
    rows = neighbours.materialize(neighbours.usable(table(spark, vectors), "vec_id", "embedding").drop("size"), "vectors")
    space = neighbours.fit(rows)
    at = space.nearest(space.place(vectors), space.centres)
    lists = spark.createDataFrame([(int(i), int(x)) for i, x in enumerate(at)], "id long, list int")
    listed = neighbours.materialize(rows.join(lists, "id").select("row", "id", "vector", "list"), "lists")
    return len(space.centres), neighbours.measured(listed, F.col("id") % 20 == 0, spark.sparkContext.broadcast(space), 20)


def test_lists_grow_with_the_rows_and_clusters_need_few_of_them(spark):
    rng = np.random.default_rng(6)
    clustered = lambda n: (rng.normal(size=(40, 24)) * 3)[rng.integers(0, 40, n)] + rng.normal(size=(n, 24)) / 3
    few, some = looked_at(spark, clustered(900)), looked_at(spark, clustered(3600))
    assert (few[0], some[0]) == (30, 60)
    assert few[1] <= 15 and some[1] <= 20
    lists, probes = looked_at(spark, rng.normal(size=(900, 24)))
    assert lists == 30 and 10 < probes <= 30


def test_measured_lists_hold_the_share_of_the_nearest_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TRIALS", 10**6)
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(400, 16))
    vectors[50:90] = vectors[50]
    rows = neighbours.usable(table(spark, vectors), "vec_id", "embedding").drop("size").withColumn("list", F.lit(0)).select("row", "id", "vector", "list")
    rows = neighbours.materialize(rows, "vectors")
    space = neighbours.fit(rows)
    at = space.nearest(space.place(vectors.astype(np.float32).astype(float)), space.centres)
    listed = rows.drop("list").join(spark.createDataFrame([(int(i), int(x)) for i, x in enumerate(at)], "id long, list int"), "id")
    listed = neighbours.materialize(listed.select("row", "id", "vector", "list"), "lists")
    probes = neighbours.measured(listed, F.col("id") % 20 == 0, spark.sparkContext.broadcast(space), 5)
    exactly = vectors.astype(np.float32).astype(float)
    turns = []
    for query in range(0, 400, 20):
        order = space.probes(space.ask(exactly[query : query + 1]), len(space.centres))[0].tolist()
        scores = (exactly * exactly[query]).sum(axis=1)
        scores[query] = -np.inf
        near = sorted(range(400), key=lambda i: (-scores[i], order.index(at[i])))[:5]
        turns += [order.index(at[i]) for i in near]
    assert probes == 1 + min(p for p in range(len(space.centres)) if np.mean(np.array(turns) <= p) >= neighbours.AIM)
