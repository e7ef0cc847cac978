"""End-to-end evaluation jobs: MMLU-style, exam-style, and the multi-model run.

Plan: items x models (explode of a literal model list, no join) -> prompts ->
``batch_chat`` (the only Python stage) -> responses written once -> scoring
(column expressions) -> per-example table -> statistics (one aggregation) ->
leaderboard (one pivot).
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import DEFAULT_EXAM_TYPES, EVAL_NAMES
from ..functions.text import normalize_response
from ..operators.aggregate import aggregate_results, leaderboard
from ..operators.evaluate import score_exam, score_mmlu
from ..operators.grade import grade_with_model
from ..operators.inference import CallPolicy
from ..operators.prompts import conversation, filter_types, mcq_prompt, pack_messages, typed_prompt
from ..operators.report import example_html, has_variants, markdown_lines, report_lines, write_reports
from ..operators.replies import DEFAULT_CHUNKS, call_stored
from ..operators.sample import sample_fixed, sample_positions
from ..sources.io import materialize, write_metrics
from ..sources.positions import with_positions

Chat = Callable[[list[dict]], str]
EVAL_LANGUAGE = "MYA"


def mmlu_prompts(items: DataFrame) -> DataFrame:
    opts = [F.col(c) for c in ("option_a", "option_b", "option_c", "option_d")]
    return items.withColumn("prompt_messages", pack_messages(mcq_prompt(F.col("question"), opts)))


def exam_prompts(items: DataFrame) -> DataFrame:
    p = typed_prompt(F.col("type"), F.col("question"), F.col("option_a"), F.col("option_b"), F.col("option_c"))
    return items.withColumn("prompt_messages", pack_messages(p))


def with_models(items: DataFrame, models: Sequence[str], eval_name: str) -> DataFrame:
    """Every item once per model: explode a literal list (map-only)."""
    return items.select(
        F.lit(eval_name).alias("eval_name"), F.explode(F.array(*[F.lit(m) for m in models])).alias("model_name"), "*"
    )


def call_models(
    requests: DataFrame,
    samplers: dict[str, Chat],
    policy: CallPolicy | None = None,
    concurrency: int = 1,
    num_partitions: int | None = None,
    responses_path: str | None = None,
    n_chunks: int = DEFAULT_CHUNKS,
    rounds: bool = False,
) -> DataFrame:
    """Every request row with its model reply (see ``operators.replies``).

    Replies are kept at ``responses_path`` by what was asked, not by item: a crash loses at
    most the chunk in flight, failed calls are repeated by the next run, and an item whose
    prompt changed is asked again. A row is never joined by its item id.
    """
    return call_stored(requests, samplers, responses_path, "prompt_messages", policy, concurrency, num_partitions, n_chunks, rounds=rounds)


def finish_examples(scored: DataFrame) -> DataFrame:
    """Add the conversation and the HTML of each example (for a report; not stored)."""
    asked = F.transform("prompt_messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return scored.withColumn("convo", conversation(asked, F.col("response_text"))).withColumn(
        "html", example_html(F.col("prompt_messages"), F.col("response_text"), F.col("answer"), F.col("extracted"), F.col("score"), has_variants(scored))
    )


def language_guard(name: str, language: str) -> None:
    """Both evals hold Burmese questions and answers only."""
    if language != EVAL_LANGUAGE:
        raise ValueError(f"{name} has no questions in {language!r}")


#: What is kept of an item beside its prompt: what scoring and grading read.
ASKED_COLUMNS = ["item_pos", "item_id", "prompt_messages", "type", "question", "answer", "sample_id"]
EXAMPLE_KEYS = ["eval_name", "model_name", "item_pos"]


def exam_examples(answered: DataFrame, grades: DataFrame | None = None) -> DataFrame:
    """Scored replies; ``grades`` of the model-graded ones, by (eval, model, item position)."""
    if grades is None:
        return score_exam(answered)
    return score_exam(answered.join(grades, EXAMPLE_KEYS, "left"), grade_output_col="grade_output")


@dataclass
class RunResult:
    examples: DataFrame  # per (eval, model, item position): prompt, response, extracted, score, metrics, errors
    metrics: DataFrame  # (eval_name, model_name, metric, value)
    counts: DataFrame  # (eval_name, model_name, n_rows, n_errors, n_invalid_grades)
    leaderboard: DataFrame  # model_name x eval_name; null where every call failed
    markdown: DataFrame  # leaderboard as markdown lines


EXAMPLE_COLUMNS = ["eval_name", "model_name", "item_pos", "item_id", "prompt_messages", "response_text", "answer", "extracted", "score", "metrics", "error", "grade_error", "grade_valid"]


def failure_counts(examples: DataFrame) -> DataFrame:
    """What the statistics of each (eval, model) leave out: failed calls, and grades that
    the grader failed to give or gave in no valid form."""
    invalid = F.col("error").isNull() & (F.col("grade_error").isNotNull() | (F.col("grade_valid") == F.lit(False)))
    return examples.groupBy("eval_name", "model_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("error").isNotNull()).alias("n_errors"),
        F.count_if(invalid).alias("n_invalid_grades"),
    )


def with_failed(metrics: DataFrame, counts: DataFrame) -> DataFrame:
    """A null ``score`` for every (eval, model) without any, so that it stays on the board."""
    keys = ["eval_name", "model_name"]
    none = counts.join(metrics.filter(F.col("metric") == "score"), keys, "left_anti")
    return metrics.unionByName(none.select(*keys, F.lit("score").alias("metric"), F.lit(None).cast("double").alias("value")))


def run(
    samplers: dict[str, Chat],
    items_by_eval: dict[str, DataFrame],
    grader: Chat | None = None,
    examples: int | None = None,
    debug: bool = False,
    exam_types: Sequence[str] | None = DEFAULT_EXAM_TYPES,
    seed: int = 0,
    out_root: str | None = None,
    policy: CallPolicy | None = None,
    concurrency: int = 1,
    num_partitions: int | None = None,
    n_chunks: int = DEFAULT_CHUNKS,
    strict: bool = False,
    language: str = EVAL_LANGUAGE,
    sampling: str = "hash",
    rounds: bool = False,
) -> RunResult | None:
    """Evaluate every model on every known eval; write metrics and reports.

    Items are known by their position in their table, so ids may repeat or be missing: each
    item is asked, scored and counted once for each model. ``sampling`` is ``hash``
    (the same items under any order of the table) or ``position`` (the positions that Python's
    seeded ``random.sample`` picks, comparable with scores published that way). With
    ``rounds`` failed calls are tried again by later jobs, and no task waits.

    Failed calls and invalid grades are left out of the statistics and counted in
    ``counts``; with ``strict`` any of them fails the run (after the replies are saved).
    With ``out_root`` the replies are kept under ``out_root/replies``: a rerun only
    calls what is still missing, and replaces its own metrics and reports.
    """
    names = []
    for name in items_by_eval:
        if name in EVAL_NAMES:
            language_guard(name, language)
            names.append(name)
        else:
            warnings.warn(f"Unrecognized evaluation '{name}'. Skipping.")
    if not names:
        return None
    models = list(samplers)
    n = 1 if debug else examples
    all_examples = []
    prompted = []
    for name in names:
        items = items_by_eval[name]
        if name == "mg12l":
            if grader is None and "SHORT_QNA" in (exam_types or ["SHORT_QNA"]):
                items = without_graded(items, exam_types)
            prompts = exam_prompts(chosen_items(filter_types(items, exam_types), n, seed, sampling, capped=True))
        else:
            prompts = mmlu_prompts(chosen_items(items, n, seed, sampling))
        prompted.append(with_models(prompts.select(*[c for c in ASKED_COLUMNS if c in prompts.columns]), models, name))
    # One work list and one store for all evals: equal prompts are called once.
    requests = prompted[0]
    for p in prompted[1:]:
        requests = requests.unionByName(p, allowMissingColumns=True)
    answered = call_models(requests, samplers, policy, concurrency, num_partitions, f"{out_root}/replies" if out_root else None, n_chunks, rounds)
    answered = materialize(answered.drop("attempts"), "answered")
    for name in names:
        mine = answered.filter(F.col("eval_name") == name)
        if name == "mg12l":
            grades = None
            if grader is not None:
                short = mine.filter(F.col("error").isNull() & (F.col("type") == "SHORT_QNA"))
                short = short.withColumn("response_text", normalize_response(F.col("response"))).drop("error")
                grades = materialize(grade_with_model(short, grader, EXAMPLE_KEYS, policy=policy), "grades")
            ex = exam_examples(mine, grades)
        else:
            ex = score_mmlu(mine)
        for c, kind in (("grade_error", "string"), ("grade_valid", "boolean")):
            if c not in ex.columns:
                ex = ex.withColumn(c, F.lit(None).cast(kind))
        all_examples.append(ex.select(*EXAMPLE_COLUMNS))
    examples_df = all_examples[0]
    for e in all_examples[1:]:
        examples_df = examples_df.unionByName(e)
    examples_df = materialize(examples_df, "examples")
    counts = failure_counts(examples_df)
    if strict and (failed := counts.filter("n_errors > 0 or n_invalid_grades > 0").collect()):
        raise RuntimeError("failures: " + ", ".join(f"{r.eval_name}/{r.model_name}: {r.n_errors} calls, {r.n_invalid_grades} grades of {r.n_rows}" for r in failed))
    metrics = with_failed(aggregate_results(examples_df.filter(F.col("error").isNull()), ["eval_name", "model_name"]), counts)
    metrics = materialize(metrics, "metrics")
    board = leaderboard(metrics, names)
    if out_root:
        mode = "debug" if debug else "full"
        write_metrics(metrics.withColumn("run_mode", F.lit(mode)), f"{out_root}/metrics")
        write_reports(report_lines(metrics, finish_examples(examples_df), "item_pos"), f"{out_root}/reports/run_mode={mode}")
    return RunResult(examples_df, metrics, counts, board, markdown_lines(board))


def chosen_items(items: DataFrame, n: int | None, seed: int, sampling: str, capped: bool = False) -> DataFrame:
    """The items to ask, with their positions in the table as ``item_pos``; chosen once, as
    they are used for prompts, grades and scores. ``capped``: a table of fewer items is
    taken whole."""
    placed = with_positions(items, "item_pos")
    if "item_id" not in placed.columns:
        placed = placed.withColumn("item_id", F.col("item_pos"))
    if sampling == "position":
        return sample_positions(placed, n, seed, "item_pos", capped)
    if sampling != "hash":
        raise ValueError(f"sampling is 'hash' or 'position', not {sampling!r}")
    # equal ids differ by their position
    return sample_fixed(placed, "item_id", n, seed, ties="item_pos")


def without_graded(items: DataFrame, exam_types: Sequence[str] | None) -> DataFrame:
    """Without a grader SHORT_QNA items cannot be scored: asked for by name they are an
    error; with no list of types any such item fails the query."""
    if exam_types:
        raise ValueError("SHORT_QNA items need a grader")
    message = F.raise_error(F.lit("SHORT_QNA items need a grader")).cast("string")
    return items.withColumn("type", F.when(F.col("type") == "SHORT_QNA", message).otherwise(F.col("type")))
