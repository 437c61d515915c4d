import re

import pytest

from conftest_llm import plain_words
from millrace.llm import decontaminate

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items, width=13):
    windows = {}
    for item, text in items:
        own = WORDS.findall(plain_words(text))
        for i in range(max(1, len(own) - width + 1) if own else 0):
            windows.setdefault(tuple(own[i : i + width]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        own, hit, found = WORDS.findall(plain_words(text)), set(), set()
        for n in sizes:
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(own[i : i + n])]
        out.append((doc, len(own), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=repr)


@pytest.fixture
def items(corpus):
    words = corpus[5][1].split()
    return [
        (1, " ".join(words[3:40])),
        (1, " ".join(words[3:40])),
        (2, " ".join(words[10:17]).upper()),
        (3, "one"),
        (None, " ".join(corpus[6][1].split()[:20])),
        (4, None),
        (5, ""),
        (6, "?!"),
        (10, corpus[40][1]),
    ]


@pytest.mark.parametrize("block_mb", [32, 0.002])
def test_hits_equal_those_of_brute_force(frame, corpus, items, block_mb):
    found = decontaminate.find(frame(corpus), frame(items, "item_id"), block_mb=block_mb)
    assert found.columns == ["doc_id", "n_words", "n_hit", "items", "spans"]
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=repr)
    assert got == brute(corpus, items)
    assert sum(n > 0 for _, _, n, _ in got) > 5


@pytest.mark.parametrize("block_mb", [32, 0.001])
def test_spans_cover_the_hit_words(frame, corpus, items, block_mb):
    texts = {i: t for i, t in corpus if i is not None and i != 0}
    for row in decontaminate.find(frame(corpus), frame(items, "item_id"), block_mb=block_mb).where("doc_id > 0").collect():
        raw = (texts[row.doc_id] or "").encode()
        inside = sum(len(WORDS.findall(plain_words(raw[s.start : s.end].decode()))) for s in row.spans)
        assert inside == row.n_hit


@pytest.mark.parametrize("block_mb", [32, 0.001])
def test_contaminated_documents_go_and_others_stay_as_they_are(frame, corpus, items, block_mb):
    docs = frame(corpus)
    kept = decontaminate.remove(docs, frame(items, "item_id"), block_mb=block_mb)
    assert kept.schema == docs.schema
    bad = [x for x in brute(corpus, items) if x[2] and 20 * x[2] >= x[1]]
    assert bad and kept.count() == len(corpus) - len(bad)
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id > 0").collect() if r.text) == sorted(
        (i, t) for i, t in corpus if i and t and i not in {b[0] for b in bad}
    )


def test_one_block_is_held_at_a_time(spark, frame, corpus, items, monkeypatch):
    """A benchmark of more than ten blocks: what is fetched at once is a block, and it is dropped before the next one."""
    held, most = set(), []
    broadcast = type(spark.sparkContext).broadcast

    def watched(self, value):
        share = broadcast(self, value)
        if isinstance(value, list):
            held.add(id(share))
            most.append((len(held), sum(len(w) + 64 for _, w, _ in value)))
            destroy = share.destroy
            share.destroy = lambda *a: (held.discard(id(share)), destroy(*a))
        return share

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", watched)
    mb = 0.0005
    decontaminate.find(frame(corpus), frame(items, "item_id"), block_mb=mb).collect()
    assert len(most) > 10 and {n for n, _ in most} == {1} and not held
    assert max(size for _, size in most) < 5 * mb * (1 << 20)


@pytest.mark.parametrize("block_mb", [32, 0.001])
def test_spans_can_be_cut_out(frame, corpus, items, block_mb):
    cut = decontaminate.remove(frame(corpus), frame(items, "item_id"), how="spans", block_mb=block_mb)
    assert cut.count() == len(corpus)
    again = decontaminate.find(cut, frame(items[:1], "item_id")).where("doc_id = 5").first()
    assert again.n_hit == 0
    with pytest.raises(ValueError):
        decontaminate.remove(frame(corpus), frame(items, "item_id"), how="half")


def test_empty_tables(frame, corpus):
    none = frame([], "item_id")
    assert decontaminate.find(frame([]), none).count() == 0
    found = decontaminate.find(frame(corpus), none).collect()
    assert len(found) == len(corpus) and all(r.n_hit == 0 and r["items"] == [] for r in found)
