import os

import random

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Columns named like those that the operators work with.
CLASHES = "k1 k2 id bits seed at k shard slot part place sends cell n_words component_id lot y list score text_key list_"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_library(spark):
    spark.sparkContext.environment["PYTHONPATH"] = HERE


@pytest.fixture
def frame(spark):
    """Rows (doc_id, text) as a table with further columns whose names clash."""

    def make(rows, id_col="doc_id", partitions=3):
        extra = [c for c in CLASHES.split() if c != id_col]
        schema = f"{id_col} long, text string, " + ", ".join(f"{c} string" for c in extra)
        return spark.createDataFrame([(i, t, *["x"] * len(extra)) for i, t in rows], schema).repartition(partitions)

    return make


def prose(rng, n, vocabulary=400):
    """n words of a small language, some upper-case, some beyond ASCII, with odd blanks between."""
    words = [f"{a}{b}" for a in ("Ba", "cé", "do", "ßu", "fi", "日本", "go", "hu") for b in range(vocabulary // 8)]
    blanks = [" "] * 12 + ["\n", "\t", "  ", "\x0b", "\r\n"]
    return "".join(rng.choice(words) + rng.choice(blanks) for _ in range(n))


@pytest.fixture
def corpus():
    """Texts with copies, near copies, shared passages, repeats within, and the odd ones: null, empty, blank, one very long."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(1, 300)) for _ in range(40)]
    shared = prose(rng, 120)
    rows = list(enumerate(texts))
    rows += [(100 + k, prose(rng, 30) + shared + prose(rng, 30)) for k in range(6)]
    rows += [(200 + k, texts[3]) for k in range(5)]
    words = texts[7].split(" ")
    for k in range(4):
        changed = list(words)
        changed[rng.randrange(len(changed))] = "changed"
        rows.append((300 + k, " ".join(changed)))
    line = prose(rng, 60)
    rows += [(400, line + "\n" + prose(rng, 20) + line), (401, "ab" * 700), (402, "ab" * 700 + "c"), (403, prose(rng, 30_000))]
    rows += [(500, None), (501, ""), (502, " \n\t "), (503, "one"), (504, "."), (505, None), (None, "no id"), (None, texts[3]), (0, texts[0])]
    return rows
