"""Corpus pipeline: language ID, near-duplicates, PII, source mixing, tokenisation.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents.  All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeflow.llm import langid, minhash, mixing, sentencepieces, surrogates
from gradeflow.llm.common import DOCUMENT_COLUMNS, read, stored
from gradeflow.llm.registry import BUDGET, PII_KEY, SENTENCEPIECE_MODEL, TARGETS


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    return langid.keep_identified(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.one_of_each(docs.select(*DOCUMENT_COLUMNS))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets surrogates; the length follows the new text."""
    out = surrogates.replace_pii(docs.select(*DOCUMENT_COLUMNS), PII_KEY)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled to the target weights of source, language and topic."""
    return mixing.sample_documents(docs.select(*DOCUMENT_COLUMNS), TARGETS, BUDGET)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what is left."""
    return sentencepieces.digests(docs, SENTENCEPIECE_MODEL)


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", near_dedup),
    ("pii_surrogates", pii),
    ("mixing_weights", mix),
    ("sentencepiece", tokenize),
]

#: Trained models and sequential updates are not expressible in SQL; the stages are
#: tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
