"""From raw documents to token ids: five stages, each written as Parquet and read again.

1. quality: documents that the classifier scores below 0.5 go.
2. near_duplicates: one document of each group of near-equal fingerprints stays, that of the smallest id.
3. repeats: passages that repeat are cut out of the texts: runs of bytes, each covered by a string of 250 bytes that starts
   elsewhere too, that hold 50 words or 400 bytes (characters covered in part stay); documents stay, even if nothing of their text is left.
4. benchmark: documents contaminated by benchmark texts go.
5. encoding: ids of the pieces of each text.

Every stage works on all that the one before kept. All but the last return the columns of their input, further ones and ones that
are named like an operator's own included.

Nulls and ties: a null text counts as an empty one and stays null until the last stage, which gives it no ids. All texts without words have
the fingerprint zero, so of those that the classifier lets pass one stays. Of a group the document of the smallest id stays; of repeated rows, or
where ids are null, one. A row without id is judged like any other. Texts of any length are taken whole. An empty table gives an
empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, pieces, quality, queries, repeats, simhash
from millrace.scratch import materialize
from millrace.workload.case import Case, table


#: Fifty words of prose take some 316 bytes, seldom less than 250.
PASSAGE = repeats.Window(length=250, anchor=80, words=50)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = quality.train(docs, table(spark, sf_dir, "labels"), F.expr(queries.LEARNED), metadata=queries.METADATA)
    return quality.keep_good(docs, machine, metadata=queries.METADATA)


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.remove(docs, n_chars_col="n_chars" if "n_chars" in docs.columns else None, window=PASSAGE)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs, queries.model_bytes())


STAGES = [
    ("quality", good),
    ("near_duplicates", single),
    ("repeats", unrepeated),
    ("benchmark", clean),
    ("encoding", encoded),
]

#: No SQL states the classifier, the fingerprints or the pieces; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = materialize(stage(spark, rows, sf_dir), name)
    return rows


CASES = {"pipeline": Case(run, ORACLE_SQL)}
