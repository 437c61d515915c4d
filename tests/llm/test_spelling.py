import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest_llm import LOWER
from millrace.llm import queries, spelling


def garbled(i, run):
    run = run.translate(LOWER)
    h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
    return run[: (k := h % len(run))] + run[k + 1 :] if h % 31 == 0 else run


def edits(word, letters):
    """All texts one edit away."""
    out = {word[:k] + word[k + 1 :] for k in range(len(word))}
    for k in range(len(word) + 1):
        out |= {word[:k] + c + word[k:] for c in letters} | {word[:k] + c + word[k + 1 :] for c in letters if k < len(word)}
    return out - {word}


def brute(counts, times=10):
    letters = {c for w in counts for c in w}
    out = {}
    for word, n in counts.items():
        close = [w for w in edits(word, letters) if w in counts] if len(word) < 200 else [w for w in counts if one_apart(word, w)]
        best = min(close, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        out[word] = (form, n, len(close), counts[form] if form else None)
    rows = []
    for word, (form, n, close, form_n) in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        rows.append((word, form, root, n, close, form_n))
    return sorted(rows)


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    head = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    tails = (a[head + 1 :], b[head + 1 :]) if len(a) == len(b) else (a[head:], b[head + 1 :]) if len(a) < len(b) else (a[head + 1 :], b[head:])
    return tails[0] == tails[1]


def vocabulary_of(rows):
    counts = Counter(garbled(i, run) for i, text in rows for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""))
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def texts_with_variants(rng):
    stems = ["".join(rng.choice("aeinrstlou" + "éÀß÷") for _ in range(rng.randint(5, 12))) for _ in range(150)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 200)):
            word = rng.choice(stems) + rng.choice(["", "s", "es"])
            if rng.random() < 0.1:
                k = rng.randrange(len(word))
                word = word[:k] + rng.choice(["", "x", "é", word[k] * 2]) + word[k + 1 :]
            words.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((i, rng.choice([" ", "1", "日", "ł", "-"]).join(words)))
    rows += [(None, rows[0][1]), (7, rows[7][1]), (200, None), (201, ""), (202, "short 日本"), (203, "ab" * 3000), (204, "ab" * 3000)]
    rows += [(205, "ab" * 3000 + "c"), (206, "ab" * 3000 + "c"), (300, " ".join(rng.choice(stems) + "ing" for _ in range(40_000)))]
    return rows


@pytest.fixture(scope="module")
def rows():
    return texts_with_variants(random.Random(8))


def found(words):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(words).collect())


def small(monkeypatch, **sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(spelling, name, value)


def test_vocabulary_against_regular_expressions(frame, rows, monkeypatch):
    small(monkeypatch, SLICE=5000, RUNS=500)
    got = {r.word: r.n for r in spelling.vocabulary(frame(rows), garble=31).collect()}
    assert got == vocabulary_of(rows)
    clean = Counter(run.translate(LOWER) for _, t in rows for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    assert {r.word: r.n for r in spelling.vocabulary(frame(rows), length=1, least=1).collect()} == clean


@pytest.mark.parametrize("sizes", [{}, {"WORDS": 20, "ASKED": 30, "LEAF": 4}, {"WORDS": 200, "LEAF": 64}, {"WORDS": 1, "ASKED": 10}])
def test_query_against_brute_force(spark, frame, rows, monkeypatch, sizes):
    small(monkeypatch, **sizes)
    got = found(spelling.vocabulary(frame(rows), garble=31))
    want = brute(vocabulary_of(rows))
    assert got == want
    assert sum(r[1] is not None for r in want) > 20


def test_the_registered_query(spark, tmp_path, frame, rows):
    frame(rows[:60]).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.CASES["op11_spelling_variants"].run(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == brute(vocabulary_of(rows[:60]))


def test_equal_vectors_and_ties(spark, monkeypatch):
    """Very many words of the same letters: one leaf, cut into blocks; equal counts: the smallest word."""
    small(monkeypatch, WORDS=50, ASKED=70, LEAF=16)
    rng = random.Random(3)
    words = {"".join(rng.sample("abcdefgh", 8)): rng.choice([2, 2, 40]) for _ in range(400)}
    words |= {"abcdefgha": 2, "abcdefghb": 30, "abcdefghc": 30, "日bcdefgh": 3, "本bcdefgh": 33, "abcdefg日": 7}
    assert found(spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)) == brute(words)


def test_chains_of_forms_lead_to_a_root(spark):
    words = {"aaaaaaa": 100_000, "aaaaaab": 10_000, "aaaaabb": 1000, "aaaabbb": 100, "aaabbbb": 10, "aabbbbb": 2, "zzzzzzz": 5}
    got = {r[0]: r[2] for r in found(spark.createDataFrame(list(words.items()), "word string, n long"))}
    assert got.pop("zzzzzzz") == "zzzzzzz"
    assert got.pop("aabbbbb") == "aabbbbb"  # 10 is not ten times 2
    assert set(got.values()) == {"aaaaaaa"}


def test_an_empty_table(frame):
    assert found(spelling.vocabulary(frame([]), garble=31)) == []
    assert found(spelling.vocabulary(frame([(1, None), (2, "")]), garble=31)) == []


def test_crc_of_many_runs_at_once():
    rng = np.random.default_rng(1)
    content = rng.integers(0, 256, 5000).astype(np.uint8)
    begin = rng.integers(0, 4000, 300)
    size = np.where(rng.random(300) < 0.05, rng.integers(250, 1000, 300), rng.integers(1, 30, 300))
    before = rng.integers(0, 1 << 32, 300).astype(np.uint32)
    want = [zlib.crc32(content[a : a + n].tobytes(), int(c)) for a, n, c in zip(begin, size, before)]
    assert spelling._crc(before.copy(), content, begin, size).tolist() == want


def test_a_long_text_is_read_in_slices_that_end_outside_of_runs(monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice(["ÀbcÿdefgÃ", "xyzxyzxyz", " ", "Łł", "日", "a" * 6000]) for _ in range(300))
    small(monkeypatch, SLICE=100)
    content = np.frombuffer(text.encode(), np.uint8)
    cut = list(spelling._slices(content))
    assert len(cut) > 20 and [a for a, _ in cut[1:]] == [b for _, b in cut[:-1]] and cut[-1][1] == len(content)
    got = Counter()
    for low, high in cut:
        got.update(spelling.runs(["5"], content[low:high], np.array([0]), np.array([high - low]), 7, 31).to_pylist())
    want = Counter(w for w in (garbled(5, run) for run in re.findall("[A-Za-zÀ-ÿ]+", text)) if len(w) >= 7)
    assert got == want


def test_near_letter_by_letter():
    rng = random.Random(2)
    words = ["".join(rng.choice("ab") for _ in range(n)) for n in (1, 1, 2, 3, 3, 4, 5, 47, 48, 49, 49, 100)]
    words += [w[:k] + c + w[k + d :] for w in words for k in (0, len(w) // 2, len(w) - 1) for c in ("", "a", "b") for d in (0, 1)]
    words = list(dict.fromkeys(w for w in words if w))
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    got = spelling.near(spelling.Letters(pa.array(words), np.zeros(256, np.int64)), a, b)
    assert got.tolist() == [one_apart(words[i], words[j]) for i, j in zip(a, b)]
