"""Language-model scores from a weighted backoff automaton.

Tokens of a text: words between blanks (A-Z lower-cased), then one end. Each context that the learning
rows show (a word, or the start) is a state. A state has an arc for each token seen after it, and a
failure arc to the state of the context one token shorter; the last state has an arc for every token. With Dirichlet
smoothing of strength ``STRENGTH``

    P(w | h) = (c(h w) + STRENGTH * P(w | shorter h)) / (c(h) + STRENGTH)
    P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1))

an arc weighs log10 P(w | h), a failure arc log10(STRENGTH / (c(h) + STRENGTH)). A text is a walk from left to
right, which takes failure arcs until there is an arc for the token, and then goes to the state that the arc leads to; all weights are
summed. All tokens of a chunk take their steps together, as the state before a token is the longest context that is a state. Every distribution
sums to one over the V known tokens and one unknown.

The automaton grows with the corpus, so no task and no broadcast holds it. The texts are stored as chunks. A
chunk asks for the counts of its distinct n-grams (64-bit hashes, sorted, packed in blocks, one for each
range of hashes), together with what it adds to them; a task per range sums what all chunks add and
answers each. A chunk then holds the part of the automaton that its texts can reach. An n-gram, however
common, is one entry per chunk. The number of blocks is chunks times ranges: raise ``CHUNK`` and ``ENTRIES``
together where there are very many.

Nulls: a null text is empty (its only token is the end). Rows for which ``learn`` is null are not learned
from. Repeated rows count as often as they occur. With nothing to learn from, N and V are 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import texts
from millrace.llm.rows import quoted
from millrace.scratch import scratch_path

ORDER = 2
STRENGTH = 4.0

#: Bytes of text in a chunk (a longer text is a chunk of its own), and n-grams that a range gets.
CHUNK = 4_000_000
ENTRIES = 3_000_000

#: Ranges there are at least, so that small inputs use all cores too.
RANGES = 64

#: Hashes of what stands before the first token and of the end.
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes, so that equal high bytes cost nothing."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(block: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(block: bytes) -> np.ndarray:
    return np.cumsum(unpack(block), dtype=np.uint64)


def tokens(content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, and the number of tokens before each text."""
    low = texts.LOWER[content]
    begin, end, before = texts.words(low, starts, ends, texts.BLANKED)
    hashed = texts.word_hashes(low, begin, end) if len(begin) else np.zeros(0, np.uint64)
    return np.insert(hashed, before[1:], END), before + np.arange(len(before))


def grams(hashed: np.ndarray, before: np.ndarray, order: int) -> np.ndarray:
    """Row m - 1: hash of the m-gram that ends at each token (the start is one token). Odd hashes are single tokens.

    Where the text does not reach back far enough, the hash is that of the longest there is.
    """
    out = np.empty((order, len(hashed)), np.uint64)
    place = np.arange(len(hashed)) - np.repeat(before[:-1], np.diff(before))
    out[0] = texts.mixed(hashed) | np.uint64(1)
    for m in range(1, order):
        shorter = np.empty_like(hashed)  # the m-gram that ends one token earlier
        shorter[:1] = START
        shorter[1:] = out[m - 1][:-1]
        shorter[place == 0] = START
        longer = texts.mixed(shorter * np.uint64(texts.BASE) + hashed) & ~np.uint64(1)
        out[m] = np.where(place >= m - 1, longer, out[m - 1])
    return out


class Automaton:
    """The part of the automaton that a chunk can reach. ``ids`` number the n-grams of each length that end at each token.

    State 0 is the last one, of no context; state 1 that of the start; state k + 2 that of the context that is n-gram k. An n-gram that
    the learning rows show is an arc, from the state of all its tokens but the last one.
    """

    def __init__(self, ids: np.ndarray, before: np.ndarray, counts: np.ndarray, total: int, kinds: int, n_texts: float):
        self.ids, self.counts, self.order = ids, counts, len(ids)
        self.place = np.arange(ids.shape[1]) - np.repeat(before[:-1], np.diff(before))
        n = len(counts)
        self.weight, self.source, self.token, self.target = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        of_state = np.concatenate(([1.0, n_texts], counts))  # each text has one start
        self.fail, self.fail_to = np.log10(STRENGTH / (of_state + STRENGTH)), np.zeros(n + 2, np.int64)
        own = np.unique(ids[0])
        self.root = np.log10((counts + 0.1) / (total + 0.1 * (kinds + 1)))
        self.weight[own], self.token[own] = self.root[own], own
        self.target[own] = np.where((counts[own] > 0) & (self.order > 1), own + 2, 0)
        for m in range(1, self.order):
            at = np.flatnonzero(self.place >= m - 1)
            grams, first = np.unique(ids[m][at], return_index=True)
            at = at[first]
            shorter = ids[m - 1][at]
            source = np.where(self.place[at] == 0, 1, ids[m - 1][np.maximum(at - 1, 0)] + 2)
            context = of_state[source]
            arc = np.log10((counts[grams] + STRENGTH * 10 ** self.weight[shorter]) / (context + STRENGTH))
            # Without an arc the failure arc is taken, and what the shorter context says.
            self.weight[grams] = np.where(counts[grams] > 0, arc, self.fail[source] + self.weight[shorter])
            self.source[grams], self.token[grams] = source, ids[0][at]
            whole = m + 1 < self.order
            self.target[grams] = grams + 2 if whole else self.target[shorter]
            if whole:
                self.fail_to[grams + 2] = shorter + 2

    def walk(self, before: np.ndarray) -> np.ndarray:
        """Of each text, the sum of the weights on its way from its first token to its end.

        A state is the longest context that is one. So the state that a walk would carry to a token is known beforehand, and all tokens
        take their failure arcs and their arc together. That each arc leads to the state of the token after it is checked.
        """
        size, order = self.ids.shape[1], self.order
        state, level = np.full(size, min(1, order - 1)), np.full(size, min(1, order - 1))
        state[self.place > 0], level[self.place > 0] = 0, 0
        for m in range(1, order):
            at = np.flatnonzero(self.place >= max(1, m - 1))
            context = self.ids[m - 1][at - 1]
            some = self.counts[context] > 0
            state[at[some]], level[at[some]] = context[some] + 2, m
        total, arc, now = np.zeros(size), np.zeros(size, np.int64), state.copy()
        for m in range(order - 1, -1, -1):
            at = np.flatnonzero(level == m)
            grams = self.ids[m][at]
            known = (self.counts[grams] > 0) | (m == 0)  # state 0 has an arc for every token
            total[at[known]] += self.weight[grams[known]]
            arc[at[known]] = grams[known]
            at = at[~known]
            total[at] += self.fail[now[at]]
            now[at], level[at] = self.fail_to[now[at]], m - 1
        inner = np.flatnonzero(self.place[1:] > 0)
        if (self.target[arc[inner]] != state[inner + 1]).any():
            raise AssertionError("An arc leads to another state than that of the token after it")
        return np.add.reduceat(total, before[:-1]) if size else np.zeros(0)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _chunks(docs: DataFrame, learn: Column, id_col: str, text_col: str, size: int) -> DataFrame:
    slim = docs.select(
        quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn")
    )
    kind = slim.schema["id"].dataType.simpleString()

    def gather(batches):
        count, rest, bytes_of = 0, [], 0

        def chunk():
            nonlocal count, rest, bytes_of
            table = pa.Table.from_batches(rest).combine_chunks()
            starts, ends, content = texts.spans(table.column("text").chunk(0))
            learned = table.column("learn").chunk(0)
            sizes = ends - starts
            n_tokens = np.diff(texts.words(content, starts, ends, texts.BLANKED)[2]) + 1
            row = [
                pa.array([TaskContext.get().partitionId() << 32 | count]),
                pa.ListArray.from_arrays(pa.array([0, len(starts)], pa.int32()), table.column("id").chunk(0)),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.ListArray.from_arrays(pa.array([0, len(starts)], pa.int32()), learned),
                pa.array([n_tokens.sum()]),
                pa.array([n_tokens[learned.to_numpy(zero_copy_only=False)].sum()]),
                pa.array([zstandard.ZstdCompressor(level=3).compress(content.tobytes())], pa.binary()),
            ]
            count, rest, bytes_of = count + 1, [], 0
            return pa.RecordBatch.from_arrays(row, names=["chunk", "ids", "sizes", "learn", "n_tokens", "n_learned", "content"])

        for batch in batches:
            for part in texts.pieces(iter([batch]), "text", max(1, size // 4)):
                rest.append(part)
                bytes_of += len(texts.spans(part.column("text"))[2])
                if bytes_of >= size:
                    yield chunk()
        if rest and sum(map(len, rest)):
            yield chunk()

    return slim.mapInArrow(
        gather, f"chunk long, ids array<{kind}>, sizes array<long>, learn array<boolean>, n_tokens long, n_learned long, content binary"
    )


def _opened(batch: pa.RecordBatch, order: int):
    """For each chunk of a batch: its number, ids, learn flags, tokens before each text, n-grams."""
    for k in range(len(batch)):
        sizes = batch.column("sizes")[k].values.to_numpy()
        content = np.frombuffer(zstandard.ZstdDecompressor().decompress(batch.column("content")[k].as_py(), max_output_size=int(sizes.sum()) + 1), np.uint8)
        ends = np.cumsum(sizes)
        hashed, before = tokens(content, ends - sizes, ends)
        learn = batch.column("learn")[k].values.to_numpy(zero_copy_only=False)
        yield batch.column("chunk")[k].as_py(), batch.column("ids")[k].values, learn, before, grams(hashed, before, order)


def _asked(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins among sorted keys."""
    width = (1 << 64) // ranges
    return np.append(np.searchsorted(keys, np.array([k * width for k in range(ranges)], np.uint64)), len(keys))


def _requests(chunks: DataFrame, order: int, ranges: int) -> DataFrame:
    """range, chunk, keys (sorted), counts (what the chunk's learning rows add): one row per block."""

    def ask(batches):
        for batch in batches:
            for chunk, _, learn, before, found in _opened(batch, order):
                taught = np.repeat(learn, np.diff(before))
                keys, inverse = np.unique(found, return_inverse=True)
                place = np.arange(found.shape[1]) - np.repeat(before[:-1], np.diff(before))
                adds = np.zeros(len(keys))
                for m, slots in enumerate(inverse.reshape(found.shape)):
                    adds += np.bincount(slots, taught & (place >= m - 1), minlength=len(keys))  # shorter ones count once
                cut = _asked(keys, ranges)
                some = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some.astype(np.int32)),
                        pa.array(np.full(len(some), chunk)),
                        pa.array([pack_sorted(keys[cut[k] : cut[k + 1]]) for k in some], pa.binary()),
                        pa.array([pack(adds[cut[k] : cut[k + 1]]) for k in some], pa.binary()),
                    ],
                    names=["range", "chunk", "keys", "counts"],
                )

    return chunks.select("chunk", "ids", "sizes", "learn", "content").mapInArrow(ask, "range int, chunk long, keys binary, counts binary")


def _answers(requests: DataFrame) -> DataFrame:
    """chunk, range, counts (of all chunks, in the order asked) and kinds (known single tokens of the range, on its first row)."""

    def answer(table: pa.Table) -> pa.Table:
        blocks = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
        adds = np.concatenate([unpack(x) for x in table.column("counts").to_pylist()])
        keys, inverse = np.unique(np.concatenate(blocks), return_inverse=True)
        totals = np.bincount(inverse, adds).astype(np.uint64)
        replies = totals[inverse]
        cut = texts.running(np.array([len(x) for x in blocks]))
        kinds = np.zeros(len(blocks), np.int64)
        kinds[0] = ((keys & np.uint64(1)) & (totals > 0)).sum()
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "range": table.column("range"),
                "counts": pa.array([pack(replies[a:b]) for a, b in zip(cut, cut[1:])], pa.binary()),
                "kinds": pa.array(kinds),
            }
        )

    return requests.groupBy("range").applyInArrow(answer, "chunk long, range int, counts binary, kinds long")


def scores(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, chunk: int = CHUNK
) -> DataFrame:
    """``id_col``, learned, n_tokens, n_known, train_tokens, base_score and score of each row.

    ``learn`` says which rows the model learns from. base_score is that of P(w), score that of P(w | h).
    """
    chunks = _stored(_chunks(docs, learn, id_col, text_col, chunk), "chunks")
    n_tokens, total = (x or 0 for x in chunks.agg(F.sum("n_tokens"), F.sum("n_learned")).first())
    ranges = max(RANGES, 1 << max(0, int(n_tokens * order // ENTRIES)).bit_length())
    answers = _stored(_answers(_requests(chunks, order, ranges)), "answers")
    kinds = answers.agg(F.sum("kinds")).first()[0] or 0
    replies = answers.groupBy("chunk").agg(F.collect_list(F.struct("range", "counts")).alias("replies"))
    kind = chunks.schema["ids"].dataType.elementType.simpleString()

    def walk(batches):
        for batch in batches:
            for k in range(len(batch)):
                (_, ids, learn, before, found) = next(_opened(batch.slice(k, 1), order))
                replies = sorted(batch.column("replies")[k].as_py(), key=lambda x: x["range"])
                known = np.concatenate([unpack(x["counts"]) for x in replies]).astype(float)
                keys, inverse = np.unique(found, return_inverse=True)
                grams_of = inverse.reshape(found.shape)
                ended = known[np.searchsorted(keys, texts.mixed(np.array([END])) | np.uint64(1))][0]
                automaton = Automaton(grams_of, before, known, total, kinds, ended)
                first, own = before[:-1], grams_of[0]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(learn),
                        pa.array(np.diff(before)),
                        pa.array(np.add.reduceat((known[own] > 0).astype(np.int64), first)),
                        pa.array(np.full(len(ids), total)),
                        pa.array(np.add.reduceat(automaton.root[own], first)),
                        pa.array(automaton.walk(before)),
                    ],
                    names=["id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return (
        chunks.join(replies, "chunk")
        .select("chunk", "ids", "sizes", "learn", "content", "replies")
        .mapInArrow(
            walk, f"id {kind}, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        )
        .withColumnRenamed("id", id_col)
    )
