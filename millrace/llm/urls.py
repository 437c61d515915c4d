"""URL filter: rules first, then naive Bayes on segmented host names and path tokens.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or the end.
A rule names a host and the start of a path; it fits that host and its subdomains, and the longest that fits
decides. Other URLs are judged by a multinomial naive Bayes model that learned from those that a rule decides.

Names in hosts are run together, so each is split into words: a unigram model of the words in the pages' texts and the
Viterbi path of least cost, -log(count / all); an unknown run of n letters costs log(all) + n log(10). Of
paths of equal cost the one of fewer words is taken, then the one whose last word is longer. The words' counts are
met by a join on the names' substrings of up to ``WORD`` letters, and longer words by their first ``WORD`` letters, so no dictionary is
sent to tasks and names and words may be of any length. Runs of digits are one token, ``#``.

The model is a table: a number per token of hosts and per token of paths, without hashing or a bound on their number. Distinct
hosts and paths are scored by joins with it; weights are added as whole numbers, so that sums do not depend on their order. Hosts and paths are
counted before they are joined, so one that many pages share is one row until the verdicts.

Nulls: a null URL, or one without ``://``, has an empty host and path; a null page has no words. With nothing to
learn from, the method allows. Repeated pages are rows of their own and count as often.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import quoted, text_key
from millrace.scratch import materialize

ALPHA = 0.1
WORD = 24

#: Weights are kept in steps of 2**-32.
STEP = float(1 << 32)

#: Rules of the production query: verdict, host, start of the path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(lowered(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (like ``net/es/``) and its verdict, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, own, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        name, verdict = F.when(fits, F.lit(own + start)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def tokens_of(text: Column) -> Column:
    parts = F.split(F.regexp_replace(text, "[0-9]+", " # "), r"[^\p{L}#]+")
    return F.filter(parts, lambda x: x != "")


_TAG = re.compile(rb"<[^>]*>")
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """word and n over whole texts; markup between < and > is not text."""

    def count(batches):
        for batch in batches:
            found: Counter[bytes] = Counter()
            for text in batch.column("text"):
                if text.is_valid:
                    found.update(x for x in _TAG.sub(b" ", text.as_py().encode()).translate(_LETTERS).split())
            yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in found], pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    slim = texts.select(quoted(text_col).cast("string").alias("text"))
    return slim.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def segment(name: str, counts: dict[str, int], total: int) -> list[str]:
    """Words of ``name`` on the path of least cost; linear in its length."""
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]  # cost, words, start of the last word
    longest, letter = max(map(len, counts), default=0), math.log(10)
    unknown = math.log(max(total, 1))
    # An unknown run costs the same per letter, so the best start of one is the best of all starts before.
    lead = (0.0, 0, 0)
    for end in range(1, len(name) + 1):
        start = lead[2]
        choices = [(best[start][0] + unknown + (end - start) * letter, best[start][1] + 1, start)]
        for start in range(max(0, end - longest), end):
            if n := counts.get(name[start:end]):
                choices.append((best[start][0] + math.log(total / n), best[start][1] + 1, start))
        best.append(min(choices))
        lead = min(lead, (best[end][0] - end * letter, best[end][1], end))
    out, end = [], len(name)
    while end:
        start = best[end][2]
        out.append(name[start:end])
        end = start
    return out[::-1]


def segments(names: DataFrame, words: DataFrame) -> DataFrame:
    """name and parts (its words) of distinct names."""
    total = words.agg(F.sum("n")).first()[0] or 0
    k1, k2 = text_key(F.col("name"))
    keyed = names.select("name", k1.alias("k1"), k2.alias("k2"))

    def cut(batches):
        for batch in batches:
            for k in range(len(batch)):
                name = batch.column("name")[k].as_py()
                runs = list({name[i : i + n] for i in range(len(name)) for n in range(1, min(WORD, len(name) - i) + 1)})
                for low in range(0, len(runs), 50_000):
                    some = runs[low : low + 50_000]
                    own = [pa.array([batch.column(c)[k].as_py()] * len(some), pa.int64()) for c in ("k1", "k2")]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(some, pa.string())], names=["k1", "k2", "run"])

    runs = keyed.mapInArrow(cut, "k1 long, k2 long, run string")
    # Longer words by how they begin; the walk looks at the whole of them.
    starts = words.select(F.substring("word", 1, WORD).alias("run"), "word", "n")
    known = runs.join(starts, "run").groupBy("k1", "k2").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def walk(batches):
        for batch in batches:
            rows = zip(batch.column("name").to_pylist(), batch.column("known").to_pylist())
            parts = [segment(name, {x["word"]: x["n"] for x in found or ()}, total) for name, found in rows]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(parts, pa.list_(pa.string()))], names=["name", "parts"])

    return keyed.join(known, ["k1", "k2"], "left").select("name", "known").mapInArrow(walk, "name string, parts array<string>")


def host_tokens(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """owner (the host), token and k (how often) of distinct hosts' segmented names."""
    named = hosts.select("host", F.explode(tokens_of(F.col("host"))).alias("name"))
    parts = materialize(segments(named.select("name").distinct(), words), "names")
    found = named.join(parts, "name").select(F.col("host").alias("owner"), F.explode("parts").alias("token"))
    return found.groupBy("owner", "token").agg(F.count(F.lit(1)).alias("k"))


def path_tokens(paths: DataFrame) -> DataFrame:
    """owner (the path), token and k of distinct paths."""
    found = paths.select(F.col("path").alias("owner"), F.explode(tokens_of(F.col("path"))).alias("token"))
    return found.groupBy("owner", "token").agg(F.count(F.lit(1)).alias("k"))


class Bayes:
    """Log odds of allow over block: ``prior``, and of each token of a kind a weight, in steps of ``1 / STEP``."""

    def __init__(self, counts: DataFrame, allowed: int, blocked: int):
        """``counts`` has kind, token, allow and block."""
        self.prior = math.log((allowed + 1) / (blocked + 1))
        about = counts.agg(F.count(F.lit(1)).alias("kinds"), F.sum("allow").alias("allow"), F.sum("block").alias("block")).first()
        room = ALPHA * (about["kinds"] + 1)  # one more for all tokens that were never seen
        sums = [(about[c] or 0) + room for c in ("allow", "block")]

        def weight(allow: Column, block: Column) -> Column:
            if not allowed or not blocked:  # one verdict only, or none: nothing to tell apart
                return F.lit(0).cast("long")
            odds = F.log((allow + ALPHA) / sums[0]) - F.log((block + ALPHA) / sums[1])
            return F.round(odds * STEP).cast("long")

        self.weights = counts.select("kind", "token", weight(F.col("allow"), F.col("block")).alias("weight"))
        self.unseen = weight(F.lit(0), F.lit(0))

    def of(self, kind: str, tokens: DataFrame) -> DataFrame:
        """``kind`` (the owner) and ``of_<kind>``, the sum of its tokens' weights."""
        own = self.weights.where(F.col("kind") == kind).select("token", "weight")
        found = tokens.join(own, "token", "left").groupBy(F.col("owner").alias(kind))
        return found.agg(F.sum(F.col("k") * F.coalesce("weight", self.unseen)).alias(f"of_{kind}"))


def train(judged: DataFrame, tokens: dict[str, DataFrame]) -> Bayes:
    """From rows (host, path, decided) and the tokens of either."""
    known = judged.where(F.col("decided").isNotNull())
    counts = None
    for kind, of in tokens.items():
        pages = known.groupBy(F.col(kind).alias("owner"), "decided").agg(F.count(F.lit(1)).alias("pages"))
        found = pages.join(of, "owner").select(F.lit(kind).alias("kind"), "token", "decided", (F.col("pages") * F.col("k")).alias("n"))
        counts = found if counts is None else counts.unionByName(found)
    both = {what: F.sum(F.when(F.col("decided") == what, F.col("n")).otherwise(0)).alias(what) for what in ("allow", "block")}
    counts = materialize(counts.groupBy("kind", "token").agg(*both.values()), "tokens")
    pages = {r["decided"]: r["n"] for r in known.groupBy("decided").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Bayes(counts, pages.get("allow", 0), pages.get("block", 0))


def verdicts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", rules=RULES
) -> DataFrame:
    """``id_col``, host, path, rule, verdict and log_odds (of the method, allow over block) of each row."""
    url = quoted(url_col).cast("string")
    host, path = host_of(url), path_of(url)
    judged = pages.select(quoted(id_col).alias("id"), host.alias("host"), path.alias("path"))
    name, decided = rule_of(F.col("host"), F.col("path"), rules)
    # Written, so that Spark can split a host or path that very many pages have.
    judged = materialize(judged.withColumns({"rule": name, "decided": decided}), "judged")
    words = materialize(word_counts(pages, text_col), "words")
    tokens = {"host": host_tokens(judged.select("host").distinct(), words), "path": path_tokens(judged.select("path").distinct())}
    tokens = {kind: materialize(of, kind) for kind, of in tokens.items()}
    model = train(judged, tokens)
    scored = judged
    for kind, of in tokens.items():
        scored = scored.join(materialize(model.of(kind, of), "scores"), kind, "left")
    odds = F.lit(model.prior) + (F.coalesce("of_host", F.lit(0)) + F.coalesce("of_path", F.lit(0))) / STEP
    said = F.coalesce("decided", F.when(odds >= 0, "allow").otherwise("block"))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", said.alias("verdict"), odds.alias("log_odds"))
