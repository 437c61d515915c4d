import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from conftest import prose
from millrace.llm import repeats


def brute(rows, length=400, words=None):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for (i, _), raw in zip(rows, raws):
        cut = []
        for a in range(len(raw) - length + 1):
            if seen[raw[a : a + length]] > 1:
                if cut and a <= cut[-1][1]:
                    cut[-1] = (cut[-1][0], a + length)
                else:
                    cut.append((a, a + length))
        cut = [(a, b) for a, b in cut if words is None or b - a >= 400 or len(raw[a:b].split()) >= words]
        out.append((str(i), len(raw), cut, hashlib.sha256(repeats.kept(raw, cut)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("group", [repeats.GROUP, 3, 1])
def test_removed_bytes_equal_those_of_brute_force(frame, corpus, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    found = repeats.repeats(frame(corpus))
    assert found.columns == ["doc_id", "n_bytes", "cut", "kept_sha256"]
    got = sorted((str(r.doc_id), r.n_bytes, [(c.start, c.end) for c in r.cut], r.kept_sha256) for r in found.collect())
    wanted = brute(corpus)
    assert got == wanted
    assert sum(bool(w[2]) for w in wanted) > 15


@pytest.mark.parametrize("group", [repeats.GROUP, 2])
@pytest.mark.parametrize("window", [repeats.Window(250, 80, 50), repeats.Window(120, 40), repeats.Window(120, 40, 12)])
def test_windows_of_other_lengths(frame, corpus, monkeypatch, group, window):
    monkeypatch.setattr(repeats, "GROUP", group)
    rng = random.Random(1)
    passage = "".join(prose(rng, 52).split("\n"))
    rows = corpus + [(600 + k, prose(rng, 40) + passage + prose(rng, 25)) for k in range(3)]
    rows += [(700 + k, "x" * 300) for k in range(2)] + [(710 + k, "ab " * 60) for k in range(2)]
    got = sorted((str(r.doc_id), r.n_bytes, [(c.start, c.end) for c in r.cut], r.kept_sha256) for r in repeats.repeats(frame(rows), window=window).collect())
    assert got == brute(rows, window.length, window.words)


def test_long_texts_are_looked_at_in_slices(frame, corpus, monkeypatch):
    monkeypatch.setattr(repeats, "SLICE", 1000)
    got = sorted((str(r.doc_id), r.n_bytes, [(c.start, c.end) for c in r.cut], r.kept_sha256) for r in repeats.repeats(frame(corpus)).collect())
    assert got == brute(corpus)


def test_all_rows_and_columns_stay(frame, corpus):
    docs = frame(corpus)
    kept = repeats.remove(docs)
    assert kept.schema == docs.schema and kept.count() == len(corpus)
    cuts = {}
    for row, (_, n, cut, _) in zip(sorted(corpus, key=lambda r: str(r[0])), brute(corpus)):
        cuts[row[0]] = cut
    texts = {r.doc_id: r.text for r in kept.where("doc_id > 0").collect()}
    for i, text in corpus:
        if i:
            assert texts[i] == (None if text is None else repeats.kept_text(text.encode(), dict(cuts)[i]))


@pytest.mark.parametrize("size", [repeats.SLICE, 1500])
def test_periodic_texts(frame, monkeypatch, size):
    """Periods of one byte to more than an anchor; stretches of all lengths around a window, within texts, at their ends, in several texts."""
    monkeypatch.setattr(repeats, "SLICE", size)
    rng = random.Random(11)
    rows = []
    for k, period in enumerate((1, 2, 3, 7, 50, 127, 128, 129, 200, 300)):
        unit = "".join(rng.choice("abcdefgh") for _ in range(period))
        for j, length in enumerate((399, 400, 400 + period, 799, 800, 900, 1300, 3000)):
            body = (unit * (length // period + 1))[rng.randrange(period) :][:length]
            rows.append((1000 * k + j, prose(rng, 3) * (j % 2) + body + prose(rng, 3) * (j % 3)))
    rows += [(90_000, "a" * 700 + "b" + "a" * 900), (90_001, "a" * 400), (90_002, "ab" * 2000 + "ba" * 2000)]
    got = sorted((str(r.doc_id), r.n_bytes, [(c.start, c.end) for c in r.cut], r.kept_sha256) for r in repeats.repeats(frame(rows)).collect())
    assert got == brute(rows)
    # One of a kind: nothing but the text itself repeats it.
    alone = [(1, rows[7][1])]
    assert [[(c.start, c.end) for c in r.cut] for r in repeats.repeats(frame(alone)).collect()] == [brute(alone)[0][2]]


def test_a_long_periodic_text_has_few_anchors(frame):
    rows = [(1, "a" * 3_000_000), (2, "abc" * 1_000_000), (3, "x" * 200)]
    found = repeats.repeats(frame(rows)).orderBy("doc_id").collect()
    assert [[(c.start, c.end) for c in r.cut] for r in found] == [[(0, 3_000_000)], [(0, 3_000_000)], []]
    places = repeats._places(repeats._keyed(frame(rows), "text"), repeats.WINDOW)
    assert places.count() < 10_000


def test_characters_covered_in_part_stay():
    raw = "aéb".encode()
    assert repeats.kept_text(raw, [(2, 4)]) == "aé"
    assert repeats.kept_text(raw, [(0, 2)]) == "éb"
    assert repeats.kept_text(raw, [(0, 4)]) == ""


def test_number_of_characters_follows_the_text(spark):
    rows = [(1, "x" * 500, 500, "a"), (2, "y", 1, "b"), (3, None, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, new string")
    assert {(r.doc_id, r.text, r.n_chars, r.new) for r in repeats.remove(docs, n_chars_col="n_chars").collect()} == {
        (1, "", 0, "a"),
        (2, "y", 1, "b"),
        (3, None, None, "c"),
    }


def test_columns_of_random_strings():
    rng = np.random.default_rng(2)
    reach, anchor = 6, 4
    for _ in range(60):
        n = int(rng.integers(1, 12))
        group = np.sort(rng.integers(0, 3, n))
        left = [bytes(rng.integers(97, 99, rng.integers(0, reach + 1)).astype(np.uint8)) for _ in range(n)]
        right = [bytes(rng.integers(97, 99, rng.integers(0, reach + 1)).astype(np.uint8)) for _ in range(n)]
        found = repeats.columns(group, left, right, anchor, reach)
        for x in range(reach + 1):
            keys = [(g, l[len(l) - x :], r[: reach - x]) if len(l) >= x and len(r) >= reach - x else None for g, l, r in zip(group, left, right)]
            seen = Counter(k for k in keys if k is not None)
            assert found[:, x].tolist() == [k is not None and seen[k] > 1 for k in keys]


def test_empty_table(frame):
    assert repeats.repeats(frame([])).count() == 0
    assert repeats.remove(frame([])).count() == 0
    assert [(r.n_bytes, r.cut) for r in repeats.repeats(frame([(1, None)])).collect()] == [(0, [])]
