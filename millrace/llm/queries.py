"""One query per operator, over whole tables, with the SQL that states its result where SQL can.

Parameters are those meant for production. Texts are dropped here and digests kept; the operators
themselves return texts, spans and ids.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from millrace.llm import decontaminate, hard_negatives, language_model, neighbours, passages, pieces, quality, repeats, shards, simhash, spelling, urls, warc
from millrace.scratch import scratch_path
from millrace.workload.case import Case, table

#: Where the vocabulary files of public tokenizers are.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
MODEL = "piece_bpe_32k.model"

#: Metadata that the quality classifier reads beside the text.
METADATA = ("n_chars",)

#: Share of the rows that the quality classifier learns from: those whose remainder is not 1.
LEARNED = "crc32(cast(doc_id as string)) % 3 <> 1"


def language_model_scores(spark, folder):
    rest = F.crc32(F.col("doc_id").cast("string")) % 10
    scores = language_model.scores(table(spark, folder, "documents"), rest != 0)
    return scores.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def sharding(spark, folder):
    text = F.coalesce("text", F.lit(""))
    sized = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return shards.shuffled(sized, 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def decontamination(spark, folder):
    found = decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (decontaminate.SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


_WORDS = r"""
    select {id}, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
    from {table}
"""

DECONTAMINATION_SQL = f"""
with d as ({_WORDS.format(id="doc_id, row_number() over () as r", table="documents")}),
b as ({_WORDS.format(id="item_id", table="benchmark")}),
w as (
    select distinct item_id, least(13, len(ws)) as n, ws[i:i + least(13, len(ws)) - 1] as win
    from (select item_id, ws, unnest(range(1, greatest(1, len(ws) - 12) + 1)) as i from b where len(ws) > 0)
),
sizes as (select distinct n from w),
p as (
    select r, n, i, ws[i:i + n - 1] as win
    from (select r, ws, n, unnest(range(1, len(ws) - n + 2)) as i from d, sizes where len(ws) >= n)
),
h as (select r, p.n, i, item_id from p join w on p.n = w.n and p.win = w.win),
hit as (select r, count(distinct j) as n_hit from (select r, unnest(range(i, i + n)) as j from h) group by r),
it as (
    select r, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct r, cast(item_id as varchar) as item from h where item_id is not null) group by r
)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
    cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join hit using (r) left join it using (r)
"""


def near_duplicates(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


def url_verdicts(spark, folder):
    return urls.verdicts(table(spark, folder, "pages"))


def suffix_dedup(spark, folder):
    return repeats.repeats(table(spark, folder, "documents")).select(
        "doc_id",
        "n_bytes",
        F.aggregate("cut", F.lit(0).cast("long"), lambda total, run: total + run["end"] - run["start"]).alias("n_removed"),
        F.size("cut").cast("long").alias("n_spans"),
        "kept_sha256",
    )


SUFFIX_DEDUP_SQL = """
with d as (select row_number() over () as r, doc_id, encode(coalesce(text, '')) as raw from documents),
w as (
    select r, i, md5(raw[i + 1:i + 400]) as m
    from (select r, raw, unnest(range(0, octet_length(raw) - 399)) as i from d where octet_length(raw) >= 400)
),
again as (select r, i from (select r, i, count(*) over (partition by m) as n from w) where n > 1),
marks as (select r, i, case when i <= lag(i) over (partition by r order by i) + 400 then 0 else 1 end as fresh from again),
runs as (
    select r, min(i) as a, max(i) + 400 as b
    from (select r, i, sum(fresh) over (partition by r order by i) as run from marks) group by r, run
),
parts as (select r, a, b, coalesce(lag(b) over (partition by r order by a), 0) as since from runs),
cut as (
    select r, string_agg(hex(raw[since + 1:a]), '' order by a) as head, max(b) as last,
        sum(b - a) as n_removed, count(*) as n_spans
    from parts join d using (r) group by r
)
select doc_id, cast(octet_length(raw) as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
    cast(coalesce(n_spans, 0) as bigint) as n_spans,
    sha256(case when last is null then raw else unhex(head || hex(raw[last + 1:])) end) as kept_sha256
from d left join cut using (r)
"""


def fitted(spark, folder):
    return quality.train(table(spark, folder, "documents"), table(spark, folder, "labels"), F.expr(LEARNED), metadata=METADATA)


def quality_scores(spark, folder):
    scores = quality.score(table(spark, folder, "documents"), fitted(spark, folder), metadata=METADATA)
    return scores.select(
        "doc_id",
        (~F.expr(LEARNED)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def substring_dedup(spark, folder):
    return passages.classes(table(spark, folder, "documents"))


def nearest_neighbours(spark, folder):
    found = neighbours.search(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


def model_bytes() -> bytes:
    return pieces.load(os.path.join(TOKENIZERS, MODEL))


def encoded(spark, folder):
    return pieces.encoded(table(spark, folder, "documents"), model_bytes(), with_ids=False)


def spelling_variants(spark, folder):
    return spelling.variants(spelling.vocabulary(table(spark, folder, "documents"), garble=31))


def hard_negative_mining(spark, folder):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings"), F.col("id") % 50 == 0, label)


HARD_NEGATIVE_SQL = """
with e as (
    select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where label is not null and embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
),
s as (
    select a.r as ar, a.vec_id as anchor_id, b.r, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score
    from e a join e b on a.vec_id % 50 = 0 and a.r <> b.r and len(a.v) = len(b.v)
),
p as (select * from s where same qualify row_number() over (partition by ar order by score desc, vec_id, r) <= 5),
n as (
    select p.ar, p.r, p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
        row_number() over (partition by p.ar, p.r order by s.score desc, s.vec_id, s.r) as rank
    from p join s on p.ar = s.ar and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from n where rank <= 3
"""


def archived(captures):
    page = F.col("metadata.fields")["page-id"]
    again = F.col("response.type") == "revisit"
    return captures.select(
        page.cast("long").alias("page_id"),
        F.when(again, F.col("origin.payload_bytes")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(again, F.col("origin.metadata.fields")["page-id"].cast("long")).alias("refers_to"),
    )


def warc_transactions(spark, folder):
    path = scratch_path(spark, "warc")
    warc.write(table(spark, folder, "pages"), path)
    return archived(warc.captures(warc.read(spark, path, payloads=False)))


WARC_SQL = """
with p as (select page_id, coalesce(html, '') as h, row_number() over () as r from pages),
f as (select *, first_value(r) over w as f, first_value(page_id) over w as o
      from p window w as (partition by h order by page_id desc nulls last, r)),
d as (select *, sha1(h) as x from f)
select page_id, cast(octet_length(encode(h)) as bigint) as payload_bytes,
    translate(to_base(cast('0x' || x[1:10] as bigint), 32, 8) || to_base(cast('0x' || x[11:20] as bigint), 32, 8)
        || to_base(cast('0x' || x[21:30] as bigint), 32, 8) || to_base(cast('0x' || x[31:40] as bigint), 32, 8),
        '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') as payload_digest,
    case when r = f then 'response' else 'revisit' end as record_type, case when r <> f then o end as refers_to
from d
"""


CASES = {
    "op1_language_model": Case(language_model_scores),
    "op2_sharding": Case(sharding),
    "op3_decontamination": Case(decontamination, DECONTAMINATION_SQL),
    "op4_simhash_near_dedup": Case(near_duplicates),
    "op5_url_filters": Case(url_verdicts),
    "op6_suffix_array_dedup": Case(suffix_dedup, SUFFIX_DEDUP_SQL),
    "op7_quality_classifier": Case(quality_scores),
    "op8_substring_dedup": Case(substring_dedup),
    "op9_nearest_neighbours": Case(nearest_neighbours),
    "op10_sentencepiece": Case(encoded),
    "op11_spelling_variants": Case(spelling_variants),
    "op12_hard_negatives": Case(hard_negative_mining, HARD_NEGATIVE_SQL),
    "op13_warc_transactions": Case(warc_transactions, WARC_SQL),
}
