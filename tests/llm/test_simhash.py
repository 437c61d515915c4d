import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash

from conftest_llm import blanked
from millrace.llm import simhash
from millrace.llm.components import components


def fingerprint(text, shingle=4):
    words = blanked(text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(values, most):
    """Index of the component of each fingerprint, by comparing all."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= most:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("wide", [simhash.WIDE, 0])
def test_fingerprints_and_components_equal_those_of_brute_force(frame, corpus, wide, monkeypatch):
    monkeypatch.setattr(simhash, "WIDE", wide)
    rows = simhash.near_duplicates(frame(corpus)).collect()
    values = [fingerprint(t) for _, t in corpus]
    roots = components_of(values, 4)
    least = {}
    for (i, _), r in zip(corpus, roots):
        least[r] = min(least.get(r, 10**9), 10**9 if i is None else i)
    least = {r: None if i == 10**9 else i for r, i in least.items()}
    wanted = sorted((str(i), f"{v:016x}", least[r]) for (i, _), v, r in zip(corpus, values, roots))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in rows) == wanted
    assert len({w[2] for w in wanted}) < len(wanted) - 10


@pytest.mark.parametrize("cut, times", [(simhash.THIRDS, 300), (simhash.HALVES, 100)])
def test_every_linked_pair_meets_at_a_home(cut, times):
    rng = np.random.default_rng(3)
    for _ in range(times):
        x = int(rng.integers(0, 2**63))
        y = x
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            y ^= 1 << int(bit)
        placed = simhash.cover(pd.Series(np.array([x, y], np.uint64).view(np.int64)), 4, cut)
        homes = placed[placed.home].anchor.groupby(placed.bits).agg(set)
        visits = placed[~placed.home].anchor.groupby(placed.bits).agg(set)
        a, b = np.array([x, y], np.uint64).view(np.int64)
        assert homes[a] & visits[b] and homes[b] & visits[a]


def test_the_anchors_are_a_perfect_code():
    words = np.arange(1 << 15, dtype=np.uint64)
    anchors, sizes = np.unique(simhash.home(words, 15), return_counts=True)
    assert len(anchors) == 1 << 11 and (sizes == 16).all()


@pytest.mark.parametrize("bits, code, reach", [(21, 15, 2), (32, 31, 3)])
def test_visits_are_all_anchors_within_reach(bits, code, reach):
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << bits, 20).astype(np.uint64)
    index, anchors = simhash.visits(words, bits, code, reach)
    assert (simhash.syndromes(anchors, code) == 0).all()
    assert (np.bitwise_count(words[index] ^ anchors) <= reach).all()
    for k, word in enumerate(words):
        near = word ^ simhash._balls(bits, reach)
        at_code = [int(x) for x in near if not np.bitwise_xor.reduce([i + 1 for i in range(code) if int(x) >> i & 1] + [0])]
        assert sorted(anchors[index == k].tolist()) == sorted(at_code)


def test_halves_compare_far_fewer_pairs_than_thirds():
    """Visitors that a fingerprint meets at its homes, among random ones."""
    rng = np.random.default_rng(9)
    met = {}
    for name, cut in (("thirds", simhash.THIRDS), ("halves", simhash.HALVES)):
        for n in (2_000, 20_000):
            bits = pd.Series(rng.integers(0, 2**63, n, dtype=np.uint64).view(np.int64))
            placed = pd.concat([simhash.cover(bits.iloc[k : k + 2_000], 4, cut) for k in range(0, n, 2_000)])
            sizes = placed.groupby("anchor").home.agg(["sum", "size"])
            met[name, n] = (sizes["sum"] * (sizes["size"] - sizes["sum"])).sum() / n
    # At each home a fingerprint meets its own visit; the others grow with n, in halves 110 times slower.
    assert 3 + 4 < met["thirds", 20_000] < 3 + 10 and 2 <= met["halves", 20_000] < 2 + 0.2
    assert met["thirds", 20_000] - met["thirds", 2_000] > 20 * max(0.01, met["halves", 20_000] - met["halves", 2_000])


@pytest.mark.parametrize("wide", [simhash.WIDE, 0])
def test_crowded_anchors_are_dealt_into_blocks(spark, monkeypatch, wide):
    monkeypatch.setattr(simhash, "WIDE", wide)
    rng = random.Random(1)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    values = sorted({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for s in seeds for _ in range(60)})
    table = spark.createDataFrame(pd.DataFrame({"bits": np.array(values, np.uint64).view(np.int64)}))
    monkeypatch.setattr(simhash, "BLOCK", 16)
    found = {r.vertex: r.root for r in components(simhash.links(table)).collect()}
    roots = components_of(values, 4)
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    groups = {}
    for v, r in zip(signed, roots):
        groups.setdefault(r, set()).add(found.get(v, v))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


def test_one_of_each_group_stays_with_all_its_columns(frame, corpus):
    docs = frame(corpus)
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    values = [fingerprint(t) for _, t in corpus]
    roots = components_of(values, 4)
    wanted = {}
    for (i, t), r in zip(corpus, roots):
        wanted.setdefault(r, []).append((i is None, i or 0))
    assert kept.count() == len(wanted)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(min(g) for g in wanted.values())


def test_empty_table_and_empty_texts(frame):
    assert simhash.near_duplicates(frame([])).count() == 0
    assert simhash.keep_one(frame([])).count() == 0
    rows = simhash.near_duplicates(frame([(4, None), (2, ""), (3, " ")])).collect()
    assert {(r.fingerprint, r.component_id) for r in rows} == {("0" * 16, 2)}
    assert simhash.fingerprint_of(pa.array([], pa.string())).tolist() == []


def test_components_of_paths_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + k) for k in range(1, 20)] + [(201, 200), (202, 201), (200, 202), (300, 300), (None, 5)]
    found = {r.vertex: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(31)}, **{100 + k: 100 for k in range(20)}, 200: 200, 201: 200, 202: 200}
