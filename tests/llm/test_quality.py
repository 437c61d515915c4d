import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import quality


@pytest.fixture
def labelled(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "été", "omega", "sigma"]
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        text = " ".join(rng.choice(words) + ("" if good or rng.random() < 0.3 else rng.choice(["%%%", "###"])) for _ in range(rng.randint(5, 80)))
        rows.append((i, text, len(text), "x", "y"))
        labels.append((i, int(good), "z"))
    rows += [(900, None, None, None, None), (901, "", 0, "", ""), (None, "alpha", 5, "x", "y"), (902, "w" * 300_000, 300_000, "x", "y")]
    labels += [(900, None, "z"), (901, 7, "z"), (None, 1, "z"), (5, 1, "z"), (5, 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, y string, lot string").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, lot string")


def test_held_out_rows_are_told_apart(labelled):
    docs, labels = labelled
    machine = quality.train(docs, labels, F.col("doc_id") % 3 != 1, metadata=("n_chars",))
    scores = quality.score(docs, machine, metadata=("n_chars",))
    assert scores.columns == ["doc_id", "score"] and scores.count() == docs.count()
    found = scores.join(labels.where("quality in (0, 1)").distinct(), "doc_id").where("doc_id % 3 = 1 and doc_id < 400").toPandas()
    good, bad = found[found.quality == 1].score.to_numpy(), found[found.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.98
    assert scores.where("score is null or score < 0 or score > 1").count() == 0


def test_good_rows_stay_with_all_their_columns(labelled):
    docs, labels = labelled
    machine = quality.train(docs, labels)
    kept = quality.keep_good(docs, machine)
    assert kept.schema == docs.schema
    wanted = {r.doc_id for r in quality.score(docs, machine).collect() if r.score >= 0.5}
    assert {r.doc_id for r in kept.collect()} == wanted and 0 < len(wanted) < docs.count()


def test_labels_of_other_rows_change_nothing(labelled):
    docs, labels = labelled
    some = F.col("doc_id") % 3 != 1
    other = labels.withColumn("quality", F.when(F.col("doc_id") % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (quality.train(docs, x, some) for x in (labels, other))
    assert (first.linear == second.linear).all() and (first.factors == second.factors).all()


def test_nothing_to_learn_from_and_empty_tables(labelled):
    docs, labels = labelled
    assert quality.train(docs, labels, F.lit(False)) is None
    assert quality.train(docs.limit(0), labels) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(docs.limit(0), None).count() == 0


def test_the_sample_is_bounded(labelled):
    docs, labels = labelled
    copies = docs.union(docs).union(docs)
    assert quality.train(copies, labels, sample=40) is not None


def test_pairs_are_summed_as_if_one_by_one():
    rng = np.random.default_rng(1)
    buckets, dense, rank = 8, 3, 2
    size = buckets + dense
    machine = quality.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, rank)), np.zeros(dense), np.ones(dense))
    offsets, at, weight = np.array([0, 3, 3, 5]), np.array([0, 4, 7, 1, 4]), rng.normal(size=5)
    z = rng.uniform(-1, 1, (3, dense))
    got = machine.margins(offsets, at, weight, z)
    for row in range(3):
        x = np.zeros(size)
        x[at[offsets[row] : offsets[row + 1]]] = weight[offsets[row] : offsets[row + 1]]
        x[buckets:] = z[row]
        pairs = sum(machine.factors[i] @ machine.factors[j] * x[i] * x[j] for i in range(size) for j in range(i))
        assert got[row] == pytest.approx(0.3 + machine.linear @ x + pairs)


def test_features_of_odd_texts_are_finite():
    batch = pa.RecordBatch.from_pydict({"text": pa.array([None, "", " ", "a", "é!\n" * 5, "\x00"]), "m": pa.array([None, float("inf"), float("nan"), -1.0, 2.0, 0.0])})
    offsets, at, weights, dense = quality.features(batch)
    assert offsets.tolist() == [0, 0, 0, 0, 1, 2, 3] and np.isfinite(dense).all() and np.isfinite(weights).all()
    assert quality.fit(pd.DataFrame({"y": [], "buckets": [], "weights": [], "dense": []})) is None
