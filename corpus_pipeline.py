"""From raw documents to token ids, in stages that each read what the one before has written."""

from __future__ import annotations

import secrets
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuekit.llm import decontaminate, pseudonyms, simhash, toxicity, word_table
from venuekit.llm.queries import WORD_BPE, table
from venuekit.sources.scratch import owned_tables, remove, shared_folder

#: Setting of the session with the key of the pseudonyms.
KEY_SETTING = "venuekit.pseudonyms.key"


def pseudonym_key(spark: SparkSession) -> str:
    """The key that the session names; a session that names none gets one of its own, known to nobody else.

    Pseudonyms stay linked across runs only if the same key is set for them.
    """
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of the classifier, which learns from all labelled ones."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, model, score_col="__score")
    return scored.where(F.col(scored.columns[-1]) < 0.5).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each set of near copies, as the SimHash operator links them."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def replace_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data and the lengths of the new texts."""
    done = pseudonyms.replace_personal(docs, pseudonym_key(spark), spans_col=None)
    if "n_chars" not in docs.columns:
        return done
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents."""
    return word_table.encode_texts(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("personal_data", replace_personal),
    ("tokens", encode),
]

#: Hashing, learning and tokenising have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row.  Of what is stored on the way only the last stage's table stays, which the result reads."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        with owned_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:  # read by nothing any more
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
