"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a text with features x is sigmoid(w0 + sum w_i x_i + sum over pairs i < j of <v_i, v_j> x_i x_j).
The pairs are summed in linear time: half of |sum v_i x_i|^2 - sum |v_i x_i|^2.

Features: each distinct word (cut at blanks, A-Z lower-cased), hashed into ``BUCKETS``, weighs its share of
the words, scaled to length one over the text; numbers that describe the text's structure; and the
metadata columns named by the caller. All statistics are of the whole text.

The model is fitted on a bounded sample: the ``SAMPLE`` labelled rows of the smallest hash of id and text.
Its parameters have a fixed size. It is fitted by one task, on features only. All rows are scored.

Nulls: a null text is an empty text; a null number of the metadata counts as 0; rows without a
label, or with one beside 0 and 1, are not learned from. With no row to learn from, every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import texts
from millrace.llm.rows import quoted

BUCKETS = 1 << 14
RANK = 4
SAMPLE = 6_000
ROUNDS = 12
SEED = 7


def _classes() -> np.ndarray:
    """For each byte: 0 other, 1 lower-case letter, 2 upper-case letter, 3 digit, 4 blank, 5 mark, 6 beyond ASCII."""
    out = np.full(256, 5, dtype=np.int64)
    out[97:123], out[65:91], out[48:58], out[128:] = 1, 2, 3, 6
    out[~texts.BLANKED] = 4
    out[[*range(9), *range(14, 32), 127]] = 0
    return out


CLASSES = _classes()


def features(batch: pa.RecordBatch, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, buckets and weights of the words of each text; a matrix of the dense features.

    ``batch`` has the text in its first column and metadata in the others.
    """
    starts, ends, content = texts.spans(batch.column(0))
    rows = len(starts)
    low = texts.LOWER[content]
    begin, end, before = texts.words(low, starts, ends, texts.BLANKED)
    hashed = texts.word_hashes(low, begin, end) if len(begin) else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(rows), np.diff(before))
    pair, counts = np.unique(row * buckets + (hashed % np.uint64(buckets)).astype(np.int64), return_counts=True)
    owner = pair // buckets
    offsets = np.searchsorted(owner, np.arange(rows + 1))
    norm = np.sqrt(np.bincount(owner, counts.astype(float) ** 2, minlength=rows))
    weights = counts / norm[owner] if len(owner) else np.zeros(0)

    size = np.maximum(1, ends - starts).astype(float)
    of_byte = np.repeat(np.arange(rows), ends - starts)
    kinds = np.bincount(of_byte * 7 + CLASSES[content], minlength=rows * 7).reshape(rows, 7)
    n_words = np.diff(before)
    some = np.maximum(1, n_words)
    lines = np.bincount(of_byte[content == 10], minlength=rows) + 1
    triples = (content[2:] == content[1:-1]) & (content[1:-1] == content[:-2]) if len(content) > 2 else np.zeros(0, bool)
    distinct = np.diff(offsets)
    top = np.zeros(rows)
    np.maximum.at(top, owner, counts)
    marks = CLASSES[low[end - 1]] == 5 if len(end) else np.zeros(0, bool)
    dense = [
        *(kinds[:, k] / size for k in range(7)),
        np.log1p(n_words) / 10,
        np.minimum(20, np.bincount(row, end - begin, minlength=rows) / some) / 20,
        distinct / some,
        top / some,
        np.minimum(1, lines / some),
        np.bincount(of_byte[: len(triples)][triples], minlength=rows) / size,
        np.bincount(row[marks], minlength=rows) / some,
    ]
    for k in range(1, batch.num_columns):
        extra = pc.fill_null(batch.column(k).cast(pa.float64(), safe=False), 0.0).to_numpy(zero_copy_only=False)
        dense.append(np.log1p(np.abs(np.nan_to_num(extra, posinf=0, neginf=0))) / 10)
    return offsets, pair % buckets, weights, np.stack(dense, axis=1)


class Machine:
    """Weights of the buckets, then of the dense features; ``mean`` and ``scale`` of the latter."""

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.bias, self.linear, self.factors, self.mean, self.scale = bias, linear, factors, mean, scale

    def margins(self, offsets, buckets, weights, dense) -> np.ndarray:
        rows = len(dense)
        z = np.clip((dense - self.mean) / self.scale, -4, 4)
        wide = len(self.linear) - z.shape[1]
        owner = np.repeat(np.arange(rows), np.diff(offsets))
        total = self.bias + z @ self.linear[wide:] + np.bincount(owner, self.linear[buckets] * weights, minlength=rows)
        for f in range(self.factors.shape[1]):
            v = self.factors[:, f]
            words = v[buckets] * weights
            sums = z @ v[wide:] + np.bincount(owner, words, minlength=rows)
            squares = (z**2) @ (v[wide:] ** 2) + np.bincount(owner, words**2, minlength=rows)
            total = total + (sums**2 - squares) / 2
        return total

    def scores(self, batch: pa.RecordBatch) -> np.ndarray:
        offsets, buckets, weights, dense = features(batch, len(self.linear) - len(self.mean))
        return 1 / (1 + np.exp(-np.clip(self.margins(offsets, buckets, weights, dense), -30, 30)))


def fit(samples: pd.DataFrame, buckets: int = BUCKETS, rank: int = RANK, rounds: int = ROUNDS) -> Machine | None:
    """Columns y, buckets, weights, dense; one row per text. Adagrad on the logistic loss, classes weighed alike."""
    y = samples["y"].to_numpy(float)
    if not len(y):
        return None
    rng = np.random.default_rng(SEED)
    dense = np.array(samples["dense"].tolist(), dtype=float)
    mean, scale = dense.mean(axis=0), dense.std(axis=0) + 1e-3
    wide, size = buckets, buckets + dense.shape[1]
    machine = Machine(0.0, np.zeros(size), rng.normal(0, 0.01, (size, rank)), mean, scale)
    own = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y <= 0).sum()))
    own *= len(y) / own.sum()
    base = float(np.log((y > 0).mean().clip(0.01, 0.99) / (y <= 0).mean().clip(0.01, 0.99)))
    seen_w, seen_v, seen_b = np.full(size, 1e-2), np.full((size, rank), 1e-2), 1e-2
    lists, scaled = samples["buckets"].tolist(), samples["weights"].tolist()
    for _ in range(rounds):
        order = rng.permutation(len(y))
        for k in range(0, len(order), 64):
            some = order[k : k + 64]
            counts = [len(lists[i]) for i in some]
            offsets = texts.running(np.array(counts))
            index = np.concatenate([lists[i] for i in some]).astype(np.int64)
            weight = np.concatenate([scaled[i] for i in some]).astype(float)
            z = np.clip((dense[some] - mean) / scale, -4, 4)
            p = 1 / (1 + np.exp(-np.clip(machine.margins(offsets, index, weight, dense[some]), -30, 30)))
            g = (p - (y[some] > 0)) * own[some] / len(some)
            owner = np.repeat(np.arange(len(some)), counts)
            at, x = np.concatenate((index, np.tile(np.arange(wide, size), len(some)))), np.concatenate((weight, z.ravel()))
            who = np.concatenate((owner, np.repeat(np.arange(len(some)), z.shape[1])))
            touched, slot = np.unique(at, return_inverse=True)
            step = np.bincount(slot, g[who] * x) + 1e-5 * machine.linear[touched]
            seen_w[touched] += step**2
            machine.linear[touched] -= 0.1 * step / np.sqrt(seen_w[touched])
            for f in range(rank):
                vx = machine.factors[at, f] * x
                sums = np.bincount(who, vx, minlength=len(some))
                step = np.bincount(slot, g[who] * x * (sums[who] - vx)) + 1e-4 * machine.factors[touched, f]
                seen_v[touched, f] += step**2
                machine.factors[touched, f] -= 0.03 * step / np.sqrt(seen_v[touched, f])
            seen_b += g.sum() ** 2
            machine.bias -= 0.1 * g.sum() / np.sqrt(seen_b)
    machine.bias += base
    return machine


def train(
    docs: DataFrame, labels: DataFrame, where: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", metadata: tuple[str, ...] = (), sample: int = SAMPLE,
) -> Machine | None:
    """A machine from the labelled rows that ``where`` (on ``docs``) admits.

    A row of several labels counts once for each. The sample is drawn by hash before any text moves to
    the task that fits; that task gets features only.
    """
    known = labels.where(quoted(label_col).isin(0, 1)).select(quoted(id_col).alias("id"), quoted(label_col).cast("int").alias("y"))
    admitted = docs.where(where) if where is not None else docs
    slim = admitted.select(
        quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"), *[quoted(c).alias(f"m{k}") for k, c in enumerate(metadata)]
    )
    lot = slim.select("id", F.xxhash64("id", "text").alias("lot")).join(known, "id").orderBy("lot", "y").limit(sample)
    chosen = F.broadcast(lot.distinct())  # at most ``sample`` rows of three numbers
    rows = slim.withColumn("lot", F.xxhash64("id", "text")).join(chosen, ["id", "lot"])

    def shrink(batches):
        for batch in texts.pieces(batches, "text"):
            order = ["text", *[f"m{k}" for k in range(len(metadata))]]
            offsets, buckets, weights, dense = features(batch.select(order))
            yield pa.RecordBatch.from_pydict(
                {
                    "lot": batch.column("lot"),
                    "y": batch.column("y"),
                    "buckets": [buckets[a:b] for a, b in zip(offsets, offsets[1:])],
                    "weights": [weights[a:b] for a, b in zip(offsets, offsets[1:])],
                    "dense": list(dense),
                },
                pa.schema([("lot", pa.int64()), ("y", pa.int32()), *[(c, pa.list_(t)) for c, t in kinds]]),
            )

    kinds = (("buckets", pa.int32()), ("weights", pa.float32()), ("dense", pa.float64()))
    shape = "lot long, y int, buckets array<int>, weights array<float>, dense array<double>"

    def learn(batches):
        some = [x for x in batches if len(x)]
        if some:
            machine = fit(pd.concat(some, ignore_index=True).sort_values(["lot", "y"], kind="stable"))
            yield pd.DataFrame(
                {
                    "bias": [machine.bias],
                    **{c: [getattr(machine, c).ravel()] for c in ("linear", "factors", "mean", "scale")},
                }
            )

    fitted = (
        rows.mapInArrow(shrink, shape)
        .dropDuplicates(["lot", "y"])
        .repartition(1)  # at most ``sample`` rows
        .mapInPandas(learn, "bias double, linear array<double>, factors array<double>, mean array<double>, scale array<double>")
        .collect()
    )
    if not fitted:
        return None
    row = fitted[0]
    return Machine(row.bias, np.array(row.linear), np.array(row.factors).reshape(-1, RANK), np.array(row.mean), np.array(row.scale))


def score(
    docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text", metadata: tuple[str, ...] = ()
) -> DataFrame:
    """``id_col`` and score (0 to 1) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # of a fixed size
    slim = docs.select(
        quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"), *[quoted(c).alias(f"m{k}") for k, c in enumerate(metadata)]
    )

    def judge(batches):
        for batch in texts.pieces(batches, "text"):
            found = _scores(shared.value, batch.select(batch.schema.names[1:]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.float64())], names=["id", "score"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(judge, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, machine: Machine | None, text_col: str = "text", metadata: tuple[str, ...] = (), least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def judge(batches):
        for batch in texts.pieces(batches, text_col):
            found = _scores(shared.value, batch.select([text_col, *metadata]))
            yield batch.filter(pa.array(found >= least, pa.bool_()))

    return docs.mapInArrow(judge, docs.schema)


def _scores(machine: Machine | None, batch: pa.RecordBatch) -> np.ndarray:
    return np.full(len(batch), 0.5) if machine is None else machine.scores(batch)
