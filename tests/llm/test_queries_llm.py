"""The registered queries: their columns, and laws that hold for whole tables."""

import os

import pytest
from pyspark.sql import functions as F

from millrace.llm import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

COLUMNS = {
    "op1_language_model": "doc_id:bigint held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double",
    "op2_sharding": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
    "op3_decontamination": "doc_id:bigint n_words:bigint n_hit:bigint n_items:bigint items_sha256:string contaminated:boolean",
    "op4_simhash_near_dedup": "doc_id:bigint fingerprint:string component_id:bigint",
    "op5_url_filters": "page_id:bigint host:string path:string rule:string verdict:string log_odds:double",
    "op6_suffix_array_dedup": "doc_id:bigint n_bytes:bigint n_removed:bigint n_spans:bigint kept_sha256:string",
    "op7_quality_classifier": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op8_substring_dedup": "doc_id:bigint n_words:bigint n_repeated:bigint n_passages:bigint n_links:bigint class_id:bigint",
    "op9_nearest_neighbours": "query_id:bigint rank:int vec_id:bigint score:double",
    "op10_sentencepiece": "doc_id:bigint n_bytes:bigint n_tokens:bigint ids_sha256:string round_trip:boolean parity:boolean",
    "op11_spelling_variants": "word:string form:string root:string n:bigint n_near:bigint form_n:bigint",
    "op12_hard_negatives": "anchor_id:bigint positive_id:bigint rank:int negative_id:bigint positive_score:bigint negative_score:bigint",
    "op13_warc_transactions": "page_id:bigint payload_bytes:bigint payload_digest:string record_type:string refers_to:bigint",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    rows = queries.CASES[name].run(spark, "/root/testdata/sf0.001")
    assert " ".join(f"{c}:{t}" for c, t in rows.dtypes) == COLUMNS[name]


def test_every_operator_is_registered():
    assert sorted(queries.CASES) == sorted(COLUMNS)


def test_documents_are_told_apart_on_held_out_rows(spark):
    rows = queries.quality_scores(spark, FOLDER).where("held_out").join(queries.table(spark, FOLDER, "labels"), "doc_id")
    right = rows.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.97


def test_texts_not_learned_from_are_likelier_with_contexts(spark):
    sums = queries.language_model_scores(spark, FOLDER).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_shards_hold_all_documents(spark):
    rows = queries.sharding(spark, FOLDER)
    assert rows.select("doc_id").distinct().count() == rows.count() == queries.table(spark, FOLDER, "documents").count()
    by_shard = rows.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last"), F.countDistinct("slot").alias("slots")).collect()
    assert len(by_shard) == 8 and all(r.n == r.last + 1 == r.slots for r in by_shard)
