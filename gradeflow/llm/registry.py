"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chatformat, collocations, extraction, langid, minhash, mixing, onebit, quality, sentencepieces, surrogates, tokencounts, voronoi
from .common import read

SENTENCEPIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_PAIR_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
BYTE_PAIR_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: For tests and queries only: a real run takes its key from its secret store.
PII_KEY = "a test key"
#: Target shares of tokens by source, language and topic; half of all tokens are sampled.
#: Other sources and other or unknown languages have a share of 0.025; every text has a topic.
TARGETS = {
    "source": {f"src{i}": 0.12 if i == 0 else 0.045 for i in range(20)},
    "lang": {"en": 0.4875, "fr": 0.195, "de": 0.1755, "es": 0.117},
    "topic": {"prose": 0.84, "short": 0.04, "licence": 0.06, "table": 0.04, "shout": 0.02},
}
BUDGET = 0.5
FIXED_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op2_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample_table(read(spark, sf_dir, "documents"), TARGETS, BUDGET)


def op3_onebit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onebit.search(read(spark, sf_dir, "embeddings"), every=50, k=5)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = tokencounts.token_lengths(read(spark, sf_dir, "documents"), BYTE_PAIR_RANKS, public_tokenizers.PATTERN)
    return tokencounts.totals(tokencounts.stored_histogram(lengths))


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_pii(docs, PII_KEY, count="n_entities")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digests(read(spark, sf_dir, "documents"), SENTENCEPIECE_MODEL)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    own = [(-1, 0, "user"), (-1, 1, "assistant")]
    for conv, turn, role in own:
        one = spark.range(1).select(F.lit(conv).cast("bigint").alias("conv_id"), F.lit(turn).cast("bigint").alias("turn"), F.lit(role).alias("role"), F.lit(FIXED_TEXT).alias("text"))
        rows = rows.unionByName(one)
    return chatformat.digests(chatformat.formatted(rows))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op9_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.search(read(spark, sf_dir, "embeddings"), every=100, k=10)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_texts(read(spark, sf_dir, "pages"), extraction.fit())


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(read(spark, sf_dir, "documents"), BYTE_PAIR_VOCABULARY, SENTENCEPIECE_MODEL)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, d.e)]) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_quality_classifier, op2_mixing_weights, op3_onebit_neighbours, op4_token_counts, op5_pii_surrogates, op6_sentencepiece, op7_chat_format, op8_minhash_near_dedup, op9_voronoi_topk, op10_language_id, op11_html_extraction, op12_phrase_collocations, op13_tokenizer_alignment]
    return {f.__name__: f for f in found}


def all_sql() -> dict[str, str]:
    return {"op7_chat_format": chatformat.SQL, "op9_voronoi_topk": OP9_SQL, "op12_phrase_collocations": collocations.SQL}
