"""Model-graded scoring (rubric) and the model equality judge."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import judge_verdict
from .inference import CallPolicy, batch_chat
from .prompts import grader_prompt, judge_prompt, pack_messages


def grade_with_model(
    df: DataFrame,
    grader: Callable[[list[dict]], str],
    key_cols: Sequence[str],
    question: str = "question",
    target: str = "answer",
    predicted: str = "response_text",
    policy: CallPolicy | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """``(key..., grade_output, grade_error)`` from one grader call per row.

    Filter the rows to grade (SHORT_QNA) before calling; join back on the keys.
    Materialise the result before using it twice.
    """
    prompts = df.select(*key_cols, pack_messages(grader_prompt(F.col(question), F.col(target), F.col(predicted))).alias("messages"))
    out = batch_chat(prompts, grader, key_cols, policy=policy, num_partitions=num_partitions)
    return out.select(*key_cols, F.col("response").alias("grade_output"), F.col("error").alias("grade_error"))


def equality_judge(
    df: DataFrame,
    judge: Callable[[list[dict]], str],
    key_cols: Sequence[str],
    expr1: str,
    expr2: str,
    policy: CallPolicy | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """``(key..., judge_reply, equal)``: the judge's yes/no on two expressions."""
    prompts = df.select(*key_cols, pack_messages(judge_prompt(F.col(expr1), F.col(expr2))).alias("messages"))
    out = batch_chat(prompts, judge, key_cols, policy=policy, num_partitions=num_partitions)
    return out.select(*key_cols, F.col("response").alias("judge_reply"), judge_verdict(F.col("response")).alias("equal"))
