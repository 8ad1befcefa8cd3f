"""One query per operator over its whole table: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuekit.llm import (
    decontaminate,
    fertility,
    langid,
    negatives,
    neighbours,
    pseudonyms,
    resample,
    shards,
    simhash,
    token_counts,
    toxicity,
    url_rules,
    word_table,
)

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
#: Vocabularies whose fertility is measured.
MEASURED = ("byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
SHARDS = 8
#: Tokens over which a text is marked.
LIMIT = 512
#: Key of the pseudonyms of the query; a user passes one of their own.
KEY = "example key"
RULES = "host string, path string, verdict string"
RULE_ROWS = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(id_col: str = "doc_id") -> Column:
    """A fifth of the documents, by their id; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def op1_two_pass_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.equal_shards(table(spark, folder, "documents").select("doc_id", "text"), SHARDS)
    return placed.select(
        "doc_id",
        shards.text_bytes().alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_language_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.fit(docs.where(~held_out()))
    return langid.label_languages(docs, model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


def op3_toxicity_filters(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs.where(~held_out()), labels.where(~held_out()))
    scored = toxicity.score_texts(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_token_transducer(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)


def op5_benchmark_windows(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULE_ROWS, RULES)
    return url_rules.judge(table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")


def op7_inverted_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


def op8_gray_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copies(table(spark, folder, "documents"))


def op9_word_table(spark: SparkSession, folder: str) -> DataFrame:
    encoded = word_table.encode_texts(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE), decoded=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.replace_personal(docs, KEY).withColumn("n_replaced", F.size("spans"))


def op11_batch_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("n_words")


def op12_slot_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh label is a wrong one, and every hundredth row an anchor."""
    vec = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vec.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_token_fertility(spark: SparkSession, folder: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in MEASURED]
    return fertility.judge(table(spark, folder, "documents"), paths)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_two_pass_shuffle,
        op2_language_spans,
        op3_toxicity_filters,
        op4_token_transducer,
        op5_benchmark_windows,
        op6_url_rules,
        op7_inverted_multi_index,
        op8_gray_simhash,
        op9_word_table,
        op10_pseudonyms,
        op11_batch_resampling,
        op12_slot_negatives,
        op13_token_fertility,
    )
}

ORACLE: dict[str, str] = {
    "op6_url_rules": """
with rules(rule_host, rule_path, rule_verdict) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
parts as (
  select page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages),
fits as (
  select host, path, rule_host || rule_path as rule, rule_verdict,
    row_number() over (partition by host, path
      order by length(rule_host) + length(rule_path) desc, length(rule_host) desc, rule_verdict desc) as place
  from (select distinct host, path from parts) p
  join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, p.host, p.path, rule, coalesce(rule_verdict, 'allow') as verdict
from parts p left join fits f on p.host = f.host and p.path = f.path and place = 1
""",
    "op12_slot_negatives": """
with usable as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.id as anchor_id, r.id, a.label = r.label as same, list_inner_product(a.v, r.v)::bigint as score
  from usable a join usable r on a.id <> r.id and a.id % 100 = 0),
positives as (
  select anchor_id, id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id,
  row_number() over (partition by anchor_id, positive_id order by score desc, id)::int as rank,
  id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, id) <= 10
""",
}
