"""Per-example scoring of recorded responses (exam and MMLU evaluations)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import SHORT_QNA_METRIC
from ..functions.extract import (
    extract_exam_mcq_raw,
    extract_fib,
    extract_mcq,
    extract_tof,
    normalize_if_nonempty,
)
from ..functions.score import exact_match, metric_map, metrics_json, parse_rubric, rubric_metrics, rubric_score, with_category
from ..functions.text import normalize_response


def score_exam(
    df: DataFrame,
    type_col: str = "type",
    answer_col: str = "answer",
    response_col: str = "response",
    grade_output_col: str | None = None,
    normalized: bool = False,
) -> DataFrame:
    """Add ``response_text`` (normalised), ``extracted``, ``score``, ``metrics``.

    MCQ/TOF/FIB extract and compare null-safely; LONG/METAPHOR extract nothing.
    With ``grade_output_col`` the SHORT_QNA rows are scored from the grader's
    rubric; an invalid grade gives a null score and an empty metric map, and
    ``grade_valid`` tells which rows these are. With ``normalized`` the rows have
    their ``response_text`` already.
    """
    t = F.col(type_col)
    out = df if normalized else df.withColumn("response_text", normalize_response(F.col(response_col)))
    # Staged columns: each regex runs once per row (CollapseProject keeps a
    # non-cheap column that is referenced twice in its own projection).
    out = out.withColumn(
        "_raw",
        F.when(t == "MCQ", extract_exam_mcq_raw("response_text", F.col(answer_col)))
        .when(t == "TOF", extract_tof("response_text"))
        .when(t == "FIB", extract_fib("response_text")),
    )
    out = out.withColumn(
        "extracted", F.when(t == "MCQ", normalize_if_nonempty("_raw")).otherwise(F.col("_raw"))
    ).drop("_raw")
    out = out.withColumn("_plain", exact_match(F.col("extracted"), F.col(answer_col)))
    if grade_output_col is None:
        return out.withColumnRenamed("_plain", "score").withColumn("metrics", metric_map(t, F.col("score")))
    graded = t == SHORT_QNA_METRIC
    out = out.withColumn("_grade", parse_rubric(F.col(grade_output_col)))
    out = out.withColumn("_gm", rubric_metrics(F.col("_grade")))
    return out.select(
        *[c for c in out.columns if c not in ("_grade", "_gm", "_plain", "extracted")],
        F.when(graded, metrics_json("_gm")).otherwise(F.col("extracted")).alias("extracted"),
        F.when(graded, rubric_score(F.col("_grade"))).otherwise(F.col("_plain")).alias("score"),
        F.when(graded, F.col("_gm")).otherwise(metric_map(t, F.col("_plain"))).alias("metrics"),
        F.when(graded, F.col("_grade")["valid"]).alias("grade_valid"),
    )


def score_mmlu(
    df: DataFrame,
    answer_col: str = "answer",
    response_col: str = "response",
    sample_id_col: str = "sample_id",
    normalized: bool = False,
) -> DataFrame:
    """Add ``response_text``, ``extracted``, ``score``, ``category`` and ``metrics``."""
    scored = df if normalized else df.withColumn("response_text", normalize_response(F.col(response_col)))
    scored = scored.withColumn("extracted", extract_mcq(F.col("response_text")))
    scored = scored.withColumn("score", exact_match(F.col("extracted"), F.col(answer_col)))
    scored = with_category(scored, sample_id_col)
    return scored.withColumn("metrics", metric_map(F.col("category"), F.col("score")))
