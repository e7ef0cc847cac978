"""Scoring expressions: exact match, rubric parsing/validation, metric maps."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import (
    DEFAULT_CATEGORY,
    PY_WHITESPACE_CLASS,
    RUBRIC,
    SHORT_QNA_METRIC,
    SUBJECT_CATEGORY,
)
from .text import as_col


def exact_match(extracted, answer) -> Column:
    """1.0 when equal, null-safe (two nulls are equal, as ``None == None``)."""
    return F.when(as_col(extracted).eqNullSafe(as_col(answer)), F.lit(1.0)).otherwise(F.lit(0.0))


@lru_cache(maxsize=1)
def _decimal_digit_map() -> tuple[str, str]:
    """Every Unicode decimal digit (category Nd) and its ASCII value, built by rule."""
    src, dst = [], []
    for cp in range(sys.maxunicode + 1):
        ch = chr(cp)
        if unicodedata.category(ch) == "Nd" and not ("0" <= ch <= "9"):
            src.append(ch)
            dst.append(str(unicodedata.digit(ch)))
    return "".join(src), "".join(dst)


def py_int(c) -> Column:
    """``int(text)`` for a run of decimal digits of any script; null if out of int range."""
    src, dst = _decimal_digit_map()
    return F.translate(as_col(c), src, dst).try_cast("int")


def rubric_value(grade_output, criterion: str) -> Column:
    """``re.search(criterion + r':\\s*(\\d+)')`` -> int, or null."""
    pattern = "(?U)" + criterion + ":" + PY_WHITESPACE_CLASS + "*(\\d+)"
    g = as_col(grade_output)
    return F.when(g.rlike(pattern), py_int(F.regexp_extract(g, pattern, 1)))


def parse_rubric(grade_output) -> Column:
    """struct(content, register, grammar, valid): all present and in range, else invalid."""
    values = [rubric_value(grade_output, name) for name, _, _ in RUBRIC]
    valid = None
    for v, (_, lo, hi) in zip(values, RUBRIC):
        ok = F.coalesce(v.between(lo, hi), F.lit(False))
        valid = ok if valid is None else (valid & ok)
    return F.struct(
        values[0].alias("content"),
        values[1].alias("register"),
        values[2].alias("grammar"),
        valid.alias("valid"),
    )


def rubric_metrics(grade) -> Column:
    """SHORT_QNA metric map from a parsed rubric; empty map when the grade is invalid."""
    g = as_col(grade)
    parts = [
        (g["content"] / F.lit(RUBRIC[0][2] * 1.0)),
        (g["register"] / F.lit(RUBRIC[1][2] * 1.0)),
        (g["grammar"] / F.lit(RUBRIC[2][2] * 1.0)),
    ]
    composite = (parts[0] + parts[1] + parts[2]) / F.lit(3.0)
    m = F.create_map(
        F.lit(SHORT_QNA_METRIC), composite,
        F.lit(RUBRIC[0][0]), parts[0],
        F.lit(RUBRIC[1][0]), parts[1],
        F.lit(RUBRIC[2][0]), parts[2],
    )
    empty = F.create_map().cast("map<string,double>")
    return F.when(g["valid"], m).otherwise(empty)


def metrics_json(metrics) -> Column:
    """The metric map as JSON text, spaced as ``json.dumps`` does."""
    entry = lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), e["value"].cast("string"))
    return F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(as_col(metrics)), entry), ", "), F.lit("}"))


def rubric_score(grade) -> Column:
    g = as_col(grade)
    composite = (g["content"] / 3.0 + g["register"] / 3.0 + g["grammar"] / 5.0) / 3.0
    return F.when(g["valid"], composite)


def metric_map(name, score) -> Column:
    """One-entry metric map ``{name: score}``."""
    return F.create_map(as_col(name), as_col(score).cast("double"))


def subject_of(sample_id) -> Column:
    """Text before the first '/' of the sample id; null stays null."""
    return F.split(as_col(sample_id), "/", 2).getItem(0)


def subject_table(spark: SparkSession) -> DataFrame:
    """The fixed 57-row subject -> category table."""
    return spark.createDataFrame(SUBJECT_CATEGORY, "subject string, category string")


def with_category(df: DataFrame, sample_id: str = "sample_id", out: str = "category") -> DataFrame:
    """Left join on the subject with the fixed-size table broadcast (57 rows, bounded)."""
    subjects = F.broadcast(subject_table(df.sparkSession).withColumnRenamed("category", "_cat"))
    joined = df.withColumn("_subject", subject_of(sample_id)).join(
        subjects, F.col("_subject") == subjects["subject"], "left"
    )
    return joined.withColumn(out, F.coalesce(F.col("_cat"), F.lit(DEFAULT_CATEGORY))).drop(
        "_subject", "subject", "_cat"
    )
