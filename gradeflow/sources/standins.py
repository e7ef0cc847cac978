"""Evaluation inputs derived from the driver's tables by plain column rules.

Each table grows with its source table, so the same plans run at any scale.
The rules are repeated as SQL in ``gradeflow.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import FALSE_WORD, QUESTION_TYPES, TRUE_WORD
from ..session import spread_to

MMLU_SUBJECTS = ["astronomy", "philosophy", "sociology", "virology", "unknown_subject"]


# Declared schemas of the driver tables this package reads (only the columns it
# uses): no schema inference pass, and parquet reads just these columns.
TABLE_SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double",
    "documents": "doc_id bigint, text string, lang string, source string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out to the number of partitions the session sets, if it sets one.

    A small file with few row groups gives a scan of a few tasks, and every
    regex after it would run on those few cores; local sessions set the number
    of cores. Large inputs have many splits: leave it unset there.
    """
    n = spread_to(df.sparkSession)
    return df.repartition(n) if n else df


def _pick(values, index_col):
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index_col == i, F.lit(v)) if expr is None else expr.when(index_col == i, F.lit(v))
    return expr


def _letter(letters: str, index_col):
    return F.substring(F.lit(letters), (index_col + 1).cast("int"), 1)


def _exam_kind(k):
    qtype = _pick(QUESTION_TYPES, k % 6)
    answer = (
        F.when(k % 50 == 49, F.lit(None).cast("string"))
        .when(qtype == "MCQ", _letter("ABC", k % 7 % 3))
        .when(qtype == "TOF", F.when(k % 4 == 1, F.lit(TRUE_WORD)).otherwise(F.lit(FALSE_WORD)))
        .otherwise(F.col("p_brand"))
    )
    return qtype, answer


def _sample_id(k):
    subject = _pick(MMLU_SUBJECTS, k % 5)
    return F.when(k % 11 == 10, F.lit(None).cast("string")).otherwise(F.concat(subject, F.lit("/test/"), k.cast("string")))


def item_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What scoring needs of the items of both evaluations, in one table."""
    k = F.col("p_partkey")
    qtype, answer = _exam_kind(k)
    return table(spark, sf_dir, "part").select(
        k.alias("item_id"), qtype.alias("type"), answer.alias("answer"), _sample_id(k).alias("sample_id"), _letter("ABCD", k % 4).alias("mmlu_answer")
    )


def exam_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exam items (type, question, options, answer) from ``part``."""
    k = F.col("p_partkey")
    qtype, answer = _exam_kind(k)
    return table(spark, sf_dir, "part").select(
        k.alias("item_id"),
        qtype.alias("type"),
        F.col("p_name").alias("question"),
        F.col("p_brand").alias("option_a"),
        F.col("p_type").alias("option_b"),
        F.col("p_size").cast("string").alias("option_c"),
        answer.alias("answer"),
    )


def mmlu_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-option items with subject-bearing sample ids, from ``part``."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("item_id"),
        _sample_id(k).alias("sample_id"),
        F.col("p_name").alias("question"),
        F.col("p_brand").alias("option_a"),
        F.col("p_type").alias("option_b"),
        F.col("p_size").cast("string").alias("option_c"),
        F.col("p_name").alias("option_d"),
        _letter("ABCD", k % 4).alias("answer"),
    )


def model_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recorded model response per ``lineitem`` row (4 models by supplier)."""
    q = F.col("l_quantity").cast("bigint")
    pk = F.col("l_partkey")
    response = (
        F.when(F.col("l_linenumber") % 5 == 4, F.lit("no marker here"))
        .when(pk % 6 == 0, F.concat(F.lit("**အဖြေ: ("), _letter("ကခဂဃ", q % 4), F.lit(")**")))
        .when(
            pk % 6 == 1,
            F.when(q % 2 == 0, F.lit(f"$အဖြေ : {TRUE_WORD}$")).otherwise(F.lit(f"$အဖြေ : {FALSE_WORD}$")),
        )
        .otherwise(F.concat(F.lit("step\nအဖြေ: (Brand#"), (q % 5).cast("string"), F.lit(")")))
    )
    raw = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    return raw.select(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.concat(F.lit("m"), (F.col("l_suppkey") % 4).cast("string")).alias("model_name"),
        pk.alias("item_id"),
        response.alias("response"),
    )


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary rows with gaps (null, '' and ' ') from ``part``."""
    k = F.col("p_partkey")
    null = F.lit(None).cast("string")
    return spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")).select(
        k.alias("row_key"),
        F.col("p_name").alias("word"),
        F.when(k % 5 == 1, null).otherwise(F.lower(F.col("p_brand"))).alias("phonetics"),
        F.when(k % 7 == 3, null).when(k % 7 == 5, F.lit("")).otherwise(F.col("p_type")).alias("meaning"),
        F.when(k % 4 == 2, null).otherwise(F.lit("noun")).alias("pos"),
        F.when(k % 9 == 2, F.lit(" ")).when(k % 9 == 4, null).otherwise(F.col("p_brand")).alias("origin"),
    )


def distil_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distillation input (instruction, input, output) from ``documents``."""
    k = F.col("doc_id")
    null = F.lit(None).cast("string")
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")).select(
        k.alias("row_key"),
        F.col("text").alias("instruction"),
        F.when(k % 4 == 0, null).when(k % 4 == 1, F.lit("  ")).otherwise(F.col("source")).alias("input"),
        F.when(k % 3 == 0, F.concat(F.lit("done "), F.col("lang")))
        .when(k % 3 == 1, F.lit(""))
        .otherwise(null)
        .alias("output"),
    )


def grader_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grader replies with three rubric lines (one missing at doc_id % 7 = 0), from ``labels``."""
    k = F.col("doc_id")
    lines = F.concat(
        F.lit("Content Relevancy: "), (k % 5).cast("string"), F.lit("\n"),
        F.lit("Register Appropriateness: "), ((k + F.col("quality")) % 4).cast("string"), F.lit("\n"),
        F.when(k % 7 == 0, F.lit("")).otherwise(
            F.concat(F.lit("Grammatical and Syntactic Competence: "), (k % 6).cast("string"))
        ),
    )
    return table(spark, sf_dir, "labels").select(k.alias("doc_id"), lines.alias("grade_output"))
