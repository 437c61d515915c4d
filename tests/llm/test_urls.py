import math
import random
import re
from collections import Counter

import pytest

from millrace.llm import urls

URLS = [
    ("http://A.Example.COM/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/2?x=/es/", "www.example.com", "/en/2", "www.example.com/en/", "allow"),
    ("https://x.www.example.com/en/", "x.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://example.com/de/", "example.com", "/de/", "com/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://b.net/es/1#top", "b.net", "/es/1", "net/es/", "block"),
    ("http://b.net/fr/a://c.com/", "b.net", "/fr/a://c.com/", "net/fr/", "block"),
    ("http://b.net/ES/1", "b.net", "/ES/1", None, None),
    ("http://b.com?x", "b.com", "", None, None),
    ("http://b.com#y/z", "b.com", "", None, None),
    ("no url", "", "", None, None),
    (None, "", "", None, None),
    ("", "", "", None, None),
    ("://", "", "", None, None),
    ("x\ny://c.net/es/q\nr", "c.net", "/es/q\nr", "net/es/", "block"),
]


def pages(spark, rows):
    table = [(k, u, h, "x", "x") for k, (u, h) in enumerate(rows)]
    return spark.createDataFrame(table, "page_id long, url string, html string, host string, bucket string")


def test_hosts_paths_and_rules(spark):
    found = urls.verdicts(pages(spark, [(u[0], None) for u in URLS])).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in found] == [u[1:4] for u in URLS]
    assert all(r.verdict == u[4] for r, u in zip(found, URLS) if u[4])
    assert all(r.verdict in ("allow", "block") for r in found)


def test_segments_have_the_least_cost(spark):
    rng = random.Random(4)
    counts = {"th": 50, "the": 90, "he": 3, "tion": 20, "on": 40, "ti": 5, "a": 9, "éa": 2}
    total = sum(counts.values())

    def cost(parts):
        return sum(math.log(total / counts[p]) if p in counts else math.log(total) + len(p) * math.log(10) for p in parts)

    def all_of(name):
        if not name:
            yield []
        for k in range(1, len(name) + 1):
            for rest in all_of(name[k:]):
                yield [name[:k], *rest]

    names = ["thetion", "tionth", "ththth", "q", "qqthe", "éaéa", "theon"] + ["".join(rng.choice("thetiona") for _ in range(9)) for _ in range(10)]
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    long_name = "th" * 40
    found = {r.name: r.parts for r in urls.segments(spark.createDataFrame([(n,) for n in [*set(names), long_name]], "name string"), words).collect()}
    for name in names:
        assert "".join(found[name]) == name
        assert cost(found[name]) == pytest.approx(min(map(cost, all_of(name))))
    assert found[long_name] == ["th"] * 40
    assert found["ththth"] == ["th"] * 3


def test_names_and_words_of_any_length_are_segmented(spark):
    """Words longer than the substrings that are joined, some alike but for their ends; one very long name."""
    rng = random.Random(6)
    long = ["".join(rng.choice("abc") for _ in range(n)) for n in (23, 24, 25, 40, 200)]
    counts = {w: 50 for w in long} | {long[3][:24] + "x" * 5: 9, long[3][:30]: 7, "the": 90}
    names = [a + b for a in [*long, "the"] for b in [*long, "the"]] + ["q".join(long), "the" * 1000 + long[4] + "zz" * 200]
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.name: r.parts for r in urls.segments(spark.createDataFrame([(n,) for n in set(names)], "name string"), words).collect()}
    for a in long:
        assert found[a + "the"] == [a, "the"] and found["the" + a] == ["the", a]
    assert found["q".join(long)] == [x for w in long for x in (w, "q")][:-1]
    assert found[names[-1]] == ["the"] * 1000 + [long[4], "zz" * 200]


def test_words_are_counted_over_whole_texts(spark):
    html = "<p class='no'>The the</p> cat&é9the <b>" + "x" * 200 + "</b>"
    found = {r.word: r.n for r in urls.word_counts(pages(spark, [(None, html), (None, None), (None, html)]), "html").collect()}
    assert found == {"the": 6, "cat": 2, "é": 2, "x" * 200: 2}


def naive_bayes(rows, parts_of):
    """log odds by counting tokens in dictionaries."""

    def tokens(text):
        return [t for t in re.split(r"[^\w#]+", re.sub("[0-9]+", " # ", text)) if t]

    def features(host, path):
        return [("host", p) for t in tokens(host) for p in parts_of[t]] + [("path", t) for t in tokens(path)]

    counts, n = {"allow": Counter(), "block": Counter()}, Counter()
    for host, path, _, said in rows:
        if said:
            counts[said].update(features(host, path))
            n[said] += 1
    smooth = urls.ALPHA * (len(counts["allow"].keys() | counts["block"].keys()) + 1)
    sums = {k: c.total() + smooth for k, c in counts.items()}
    out = []
    for host, path, _, _ in rows:
        x = math.log((n["allow"] + 1) / (n["block"] + 1))
        for f in features(host, path):
            x += math.log((counts["allow"][f] + urls.ALPHA) / sums["allow"]) - math.log((counts["block"][f] + urls.ALPHA) / sums["block"])
        out.append(x)
    return out


def test_the_method_equals_plain_naive_bayes(spark):
    rng = random.Random(9)
    words = ["th", "on", "sh", "tion"]
    rows = []
    for _ in range(300):
        host = rng.choice(["www.", "blog.", "", "m2."]) + rng.choice(words) + rng.choice(words) + ".example." + rng.choice(["com", "net", "org"])
        rows.append((f"http://{host}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randint(1, 999)}.html?x", f"<i>{rng.choice(words)} on</i>"))
    rows += [(None, None), ("x", "")]
    found = urls.verdicts(pages(spark, rows)).orderBy("page_id").collect()
    table = urls.word_counts(pages(spark, rows), "html")
    names = {t for r in found for t in re.split(r"[^\w#]+", re.sub("[0-9]+", " # ", r.host)) if t}
    parts_of = {r.name: r.parts for r in urls.segments(spark.createDataFrame([(n,) for n in names], "name string"), table).collect()}
    known = [(r.host, r.path, r.page_id, r.verdict if r.rule else None) for r in found]
    odds = naive_bayes(known, parts_of)
    assert [r.log_odds for r in found] == pytest.approx(odds)
    assert all(r.verdict == ("allow" if x >= 0 else "block") for r, x in zip(found, odds) if r.rule is None)
    # What the rules say is learned: most pages that rules decide get the same verdict from the method.
    agree = [(r.log_odds >= 0) == (r.verdict == "allow") for r in found if r.rule]
    assert sum(agree) > 0.7 * len(agree)


def test_empty_table(spark):
    assert urls.verdicts(pages(spark, [])).count() == 0
