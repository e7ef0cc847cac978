"""Registered queries: each reads the driver tables at ``sf_dir`` and returns a DataFrame.

Every computed column is aliased to the name its oracle SQL uses
(``gradeflow.plans.oracle_sql``). Model calls in these queries go to
deterministic stand-in chat functions (below), so the oracle can repeat them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import DEFAULT_EXAM_TYPES
from ..functions import extract as X
from ..functions.score import parse_rubric, rubric_metrics, rubric_score
from ..functions.text import judge_verdict, message_html, normalize_response
from ..operators.aggregate import aggregate_results, leaderboard as pivot_board
from ..operators.distil import run_distillation
from ..operators.evaluate import score_exam, score_mmlu
from ..operators.generate import DEFAULT_TEMPLATE_GROUPS, fill_missing, generate, reject_counts
from ..operators.grade import grade_with_model
from ..operators.inference import CallPolicy, bad_request_fallback, batch_chat, retry_any, retry_rate_limit
from ..operators.prompts import (
    alpaca_prompt,
    conversation,
    filter_types,
    grader_prompt,
    judge_prompt,
    mcq_prompt,
    pack_messages,
    simple_prompt,
    typed_prompt,
)
from ..operators.report import EXAMPLE_END, example_html, markdown_lines, report_lines
from ..operators.sample import debug_head, sample_fixed
from ..session import scratch_path, spread_to
from ..sources import io as IO
from ..sources import standins as S

EXAM = "mg12l"
MMLU = "mmlu_lite"
DIGITS = 9  # oracle compare precision for statistics
SAMPLE_N = 100
SEED = 0
SYSTEM_MESSAGE = "You are a helpful assistant."
NO_RETRY = CallPolicy(max_attempts=3, backoff_base=0.0, retryable=retry_rate_limit)


# --- deterministic stand-in chat functions (repeated in the oracle SQL) ------

def echo_chat(messages: list[dict]) -> str:
    """Replies with the prompt length; fails on lengths = 3 (mod 7)."""
    n = len(messages[-1]["content"])
    if n % 7 == 3:
        raise ValueError("synthetic failure")
    return f"  reply {n}\n"


def flaky_chat(messages: list[dict]) -> str:
    """As ``echo_chat``, and also fails on lengths divisible by 5."""
    n = len(messages[-1]["content"])
    if n % 5 == 0:
        raise ValueError("synthetic outage")
    return echo_chat(messages)


def rubric_chat(messages: list[dict]) -> str:
    """A grader whose three scores follow from the prompt length."""
    n = len(messages[-1]["content"])
    return (
        f"Scores follow.\nContent Relevancy: {n % 4}\nRegister Appropriateness: {n % 3}\n"
        f"Grammatical and Syntactic Competence: {n % 6}\n"
    )


def label_chat(messages: list[dict]) -> str:
    """Stand-in model 'ma': picks an option label from the prompt length."""
    n = len(messages[-1]["content"])
    return "Reasoning.\nအဖြေ: (" + "ကခဂဃ"[n % 4] + ")"


def word_chat(messages: list[dict]) -> str:
    """Stand-in model 'mb': one of four reply shapes by prompt length."""
    n = len(messages[-1]["content"])
    return ["**အဖြေ: မှန်**", "အဖြေ: Brand#3", "$အဖြေ: ဂ$", "no answer"][n % 4]


def judge_chat(messages: list[dict]) -> str:
    n = len(messages[-1]["content"])
    return "Yes" if n % 3 == 0 else " no\n"


def flaky_label_chat(messages: list[dict]) -> str:
    """As ``label_chat``, but fails on prompt lengths = 3 (mod 7)."""
    if len(messages[-1]["content"]) % 7 == 3:
        raise ValueError("synthetic failure")
    return label_chat(messages)


def down_chat(messages: list[dict]) -> str:
    raise ConnectionError("synthetic outage")


def flaky_rubric_chat(messages: list[dict]) -> str:
    """As ``rubric_chat``, but fails on prompt lengths divisible by 5."""
    if len(messages[-1]["content"]) % 5 == 0:
        raise ValueError("synthetic failure")
    return rubric_chat(messages)


class BadRequestError(Exception):
    """What model clients raise for a request they refuse."""


def limited_chat(messages: list[dict]) -> str:
    """Over the limit, refused, failing or answered, by prompt length."""
    n = len(messages[-1]["content"])
    if n % 5 == 0:
        raise RuntimeError("rate Limit reached")
    if n % 7 == 0:
        raise BadRequestError("refused")
    if n % 11 == 0:
        raise ValueError("synthetic failure")
    return f"reply {n}"


E2E_MODELS = {"ma": label_chat, "mb": word_chat}


# --- helpers -------------------------------------------------------------------

def _stats_out(agg: DataFrame, eval_name: str, group_cols=("model_name",)) -> DataFrame:
    return agg.select(F.lit(eval_name).alias("eval_name"), *group_cols, "metric", F.round("value", DIGITS).alias("value"))


QUESTION_COLUMNS = ["question", "option_a", "option_b", "option_c"]


def exam_scored(spark: SparkSession, sf_dir: str, types=DEFAULT_EXAM_TYPES, more=()) -> DataFrame:
    """Recorded responses joined once to their items (with ``more`` item columns) and scored."""
    items = filter_types(S.exam_items(spark, sf_dir), types).select("item_id", "type", "answer", *more)
    return score_exam(S.model_responses(spark, sf_dir).join(items, "item_id"))


def exam_messages():
    return pack_messages(typed_prompt(F.col("type"), F.col("question"), F.col("option_a"), F.col("option_b"), F.col("option_c")))


def mmlu_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = S.mmlu_items(spark, sf_dir).select("item_id", "sample_id", "answer")
    return score_mmlu(S.model_responses(spark, sf_dir).join(items, "item_id"))


def both_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of both evaluations from one scan, one join and one normalisation of the responses."""
    responses = S.model_responses(spark, sf_dir).withColumn("response_text", normalize_response(F.col("response")))
    rows = responses.join(S.item_answers(spark, sf_dir), "item_id")
    keep = ["model_name", "type", "response_text", "sample_id", "mmlu_answer"]
    exam = score_exam(rows, normalized=True).select(*keep, F.struct(F.lit(EXAM).alias("eval_name"), "score", "metrics").alias("exam"))
    both = score_mmlu(exam, answer_col="mmlu_answer", normalized=True)
    scores = F.array(F.when(F.col("type").isin(list(DEFAULT_EXAM_TYPES)), F.col("exam")), F.struct(F.lit(MMLU).alias("eval_name"), "score", "metrics"))
    long = both.select("model_name", F.inline(F.filter(scores, lambda x: x.isNotNull())))
    return aggregate_results(long, ["eval_name", "model_name"]).select("eval_name", "model_name", "metric", F.round("value", DIGITS).alias("value"))


# --- evaluation ----------------------------------------------------------------

def eval_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: exam evaluation of 4 models, mean/std per (model, question type) and score."""
    return _stats_out(aggregate_results(exam_scored(spark, sf_dir), ["model_name"]), EXAM)


def category_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MMLU evaluation: per-category and overall mean/std per model."""
    return _stats_out(aggregate_results(mmlu_scored(spark, sf_dir), ["model_name"]), MMLU)


def metric_stats_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four stats for the score, min/max only for MCQ, mean/std otherwise."""
    agg = aggregate_results(
        exam_scored(spark, sf_dir), ["model_name"], name2stats={"score": ("mean", "std", "min", "max"), "MCQ": ("min", "max")}
    )
    return _stats_out(agg, EXAM)


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headline score per model (rows) and eval (columns)."""
    return pivot_board(both_metrics(spark, sf_dir), [EXAM, MMLU])


def leaderboard_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown_lines(leaderboard(spark, sf_dir))


def _e2e_run(spark: SparkSession, sf_dir: str):
    from .evals import run

    items = {MMLU: S.mmlu_items(spark, sf_dir), EXAM: S.exam_items(spark, sf_dir)}
    return run(E2E_MODELS, items, policy=NO_RETRY, num_partitions=spread_to(spark), n_chunks=1)


def eval_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full run: items x 2 models -> prompts -> model calls -> scoring -> statistics."""
    m = _e2e_run(spark, sf_dir).metrics
    return m.select("eval_name", "model_name", "metric", F.round("value", DIGITS).alias("value"))


def eval_run_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _e2e_run(spark, sf_dir).leaderboard
    return b.select("model_name", F.round(EXAM, DIGITS).alias(EXAM), F.round(MMLU, DIGITS).alias(MMLU))


def stream_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exam scorecard computed by Structured Streaming over response files.

    Responses land as files; each micro-batch (one file) is scored against the
    static item table and folded into running (n, sum) state per (model, metric).
    """
    from ..streaming.distil_stream import latest_scores, score_stream

    src = scratch_path(spark, "stream_responses")
    S.model_responses(spark, sf_dir).write.parquet(src)
    responses = spark.read.parquet(src)
    items = filter_types(S.exam_items(spark, sf_dir), DEFAULT_EXAM_TYPES)
    out = scratch_path(spark, "stream_scores")
    q = score_stream(spark, src, responses.schema, items, out, max_files_per_trigger=2)
    q.awaitTermination()
    return latest_scores(spark, out).select(
        F.lit(EXAM).alias("eval_name"), "model_name", "metric", "n", F.round(F.col("sum") / F.col("n"), DIGITS).alias("value")
    )


def eval_run_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run in which calls and grades fail by rule: what its statistics leave out."""
    from .evals import run

    out = run(
        {"ma": flaky_label_chat, "mb": down_chat}, {EXAM: S.exam_items(spark, sf_dir)}, grader=flaky_rubric_chat, exam_types=None,
        policy=NO_RETRY, num_partitions=spread_to(spark), n_chunks=1,
    )
    return out.counts.join(out.leaderboard, "model_name").select("eval_name", "model_name", "n_rows", "n_errors", "n_invalid_grades", F.col(EXAM).isNull().alias("no_score"))


def eval_run_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run twice on one output folder: the metrics and reports read back from
    its files are those of one run."""
    from .evals import run

    root = scratch_path(spark, "rerun")
    for _ in range(2):
        run(E2E_MODELS, {MMLU: S.mmlu_items(spark, sf_dir)}, policy=NO_RETRY, out_root=root, num_partitions=spread_to(spark), n_chunks=2)
    keys = ["eval_name", "model_name"]
    metrics = IO.read_metrics(spark, f"{root}/metrics", run_mode="full").select(*keys, "metric", F.round("value", DIGITS).alias("value"))
    lines = spark.read.text(f"{root}/reports/run_mode=full")
    counts = lines.groupBy(*keys).agg(
        F.count_if(F.col("value").startswith("<!DOCTYPE")).cast("double").alias("report heads"),
        F.count_if(F.col("value").endswith(EXAMPLE_END)).cast("double").alias("report examples"),
    )
    return metrics.unionByName(counts.unpivot(keys, ["report heads", "report examples"], "metric", "value"))


def retry_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls that fail by rule under two policies: only rate limits are tried again and a
    bad request has a fixed reply, or every error is tried again."""
    docs = S.table(spark, sf_dir, "documents").select("doc_id", pack_messages(F.col("text")).alias("messages"))
    careful = CallPolicy(max_attempts=3, backoff_base=0.0, retryable=retry_rate_limit, fallback=bad_request_fallback)
    stubborn = CallPolicy(max_attempts=2, backoff_base=0.0, retryable=retry_any)
    parts = [
        batch_chat(docs, limited_chat, ["doc_id"], policy=p, concurrency=c, num_partitions=spread_to(spark)).select(F.lit(name).alias("policy"), "*")
        for name, p, c in (("careful", careful, 4), ("stubborn", stubborn, 1))
    ]
    return parts[0].unionByName(parts[1])


def exact_match_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-response score over all exam types (null answer + nothing extracted = 1.0)."""
    items = S.exam_items(spark, sf_dir).select("item_id", "type", "answer")
    scored = score_exam(S.model_responses(spark, sf_dir).join(items, "item_id"))
    return scored.select("l_orderkey", "l_linenumber", "type", "extracted", "score")


# --- prompts -------------------------------------------------------------------

def mcq_prompt_4(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = S.mmlu_items(spark, sf_dir)
    opts = [F.col(c) for c in ("option_a", "option_b", "option_c", "option_d")]
    return items.select("item_id", mcq_prompt(F.col("question"), opts).alias("prompt"))


def typed_prompt_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = S.exam_items(spark, sf_dir)
    p = typed_prompt(F.col("type"), F.col("question"), F.col("option_a"), F.col("option_b"), F.col("option_c"))
    return items.select("item_id", "type", p.alias("prompt"))


def type_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_types(S.exam_items(spark, sf_dir), DEFAULT_EXAM_TYPES).select("item_id", "type", "answer")


def chat_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a user message after a system message, one row per message."""
    docs = S.spread(S.table(spark, sf_dir, "documents").select("doc_id", "text"))
    packed = docs.select("doc_id", pack_messages(F.col("text"), system=SYSTEM_MESSAGE).alias("m"))
    return packed.select("doc_id", F.posexplode("m").alias("pos", "msg")).select(
        "doc_id", "pos", F.col("msg.role").alias("role"), F.col("msg.content").alias("content")
    )


def convo_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt messages plus the normalised reply, one row per message."""
    scored = exam_scored(spark, sf_dir, types=None, more=QUESTION_COLUMNS)
    rows = scored.select("l_orderkey", "l_linenumber", conversation(exam_messages(), F.col("response_text")).alias("c"))
    return rows.select("l_orderkey", "l_linenumber", F.posexplode("c").alias("pos", "msg")).select(
        "l_orderkey", "l_linenumber", "pos", F.col("msg.role").alias("role"), F.col("msg.content").alias("content")
    )


def message_html_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = S.spread(S.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    # every third message is one of several variants of its turn
    variant = F.when(F.col("turn") % 3 == 1, F.concat(F.lit("<"), (F.col("conv_id") % 4).cast("string"), F.lit(">")))
    return conv.select("conv_id", "turn", message_html(F.col("role"), F.col("text"), variant).alias("html"))


def examples_html(scored: DataFrame) -> DataFrame:
    """The HTML of each scored response with its question."""
    html = example_html(exam_messages(), F.col("response_text"), F.col("answer"), F.col("extracted"), F.col("score"))
    return scored.withColumn("html", html)


def example_html_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples_html(exam_scored(spark, sf_dir, more=QUESTION_COLUMNS)).select("l_orderkey", "l_linenumber", "html")


def grader_prompt_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = S.exam_items(spark, sf_dir).filter(F.col("type") == "SHORT_QNA").select("item_id", "question", "answer")
    resp = S.model_responses(spark, sf_dir).join(items, "item_id")
    return resp.select(
        "l_orderkey", "l_linenumber",
        grader_prompt(F.col("question"), F.col("answer"), normalize_response(F.col("response"))).alias("prompt"),
    )


def judge_prompt_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = exam_scored(spark, sf_dir)
    return scored.select("l_orderkey", "l_linenumber", judge_prompt(F.col("extracted"), F.col("answer")).alias("prompt"))


def judge_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted vs. expected answer judged by a (stand-in) model, reply parsed to yes/no."""
    from ..operators.grade import equality_judge

    scored = exam_scored(spark, sf_dir)
    out = equality_judge(scored, judge_chat, ["l_orderkey", "l_linenumber"], "extracted", "answer", policy=NO_RETRY, num_partitions=spread_to(spark))
    return out.select("l_orderkey", "l_linenumber", "equal")


def multimodal_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as a text part (its url) and an image part (a data URI of its bytes)."""
    from ..operators.prompts import image_part_from_binary, text_part

    pages = S.spread(S.table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    parts = F.array(text_part(F.col("url")), image_part_from_binary(F.col("html").cast("binary")))
    return pages.select("page_id", F.posexplode(parts).alias("pos", "p")).select(
        "page_id", "pos", F.col("p.type").alias("type"), F.col("p.text").alias("text"), F.col("p.image_url").alias("image_url")
    )


def judge_verdict_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge replies derived from lineitem, parsed to yes/no."""
    li = S.spread(S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))
    reply = (
        F.when(F.col("l_linenumber") % 4 == 0, F.lit("Yes"))
        .when(F.col("l_linenumber") % 4 == 1, F.lit(" yes\n"))
        .when(F.col("l_linenumber") % 4 == 2, F.lit("No"))
        .otherwise(F.lit("YES."))
    )
    return li.select("l_orderkey", "l_linenumber", judge_verdict(reply).alias("equal"))


# --- text functions ------------------------------------------------------------

def normalize_response_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = S.table(spark, sf_dir, "documents").select(F.lit("doc").alias("src"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text")
    conv = S.table(spark, sf_dir, "conversations").select(F.lit("conv").alias("src"), F.col("conv_id").alias("id"), "turn", "text")
    both = S.spread(docs.unionByName(conv))
    return both.select("src", "id", "turn", normalize_response(F.col("text")).alias("normalized"))


def _normalized_responses(spark, sf_dir):
    return S.model_responses(spark, sf_dir).select("l_orderkey", "l_linenumber", normalize_response(F.col("response")).alias("t"))


def answer_extract_mcq(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _normalized_responses(spark, sf_dir)
    return r.select("l_orderkey", "l_linenumber", X.extract_mcq(F.col("t")).alias("extracted"))


def answer_extract_tof(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _normalized_responses(spark, sf_dir)
    return r.select("l_orderkey", "l_linenumber", X.extract_tof(F.col("t")).alias("extracted"))


def answer_extract_fib(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _normalized_responses(spark, sf_dir)
    return r.select("l_orderkey", "l_linenumber", X.extract_fib(F.col("t")).alias("extracted"))


def answer_extract_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LONG/METAPHOR items: nothing is extracted, so the score is 1.0 only for a null answer."""
    scored = exam_scored(spark, sf_dir, types=["LONG_QNA", "METAPHOR_QNA"])
    return scored.select("l_orderkey", "l_linenumber", "type", "extracted", "score")


def english_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = S.spread(S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"))
    letter = F.substring(F.lit("ABCD"), (F.col("l_partkey") % 4 + 1).cast("int"), 1)
    r = (
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("So the Answer: $"), letter, F.lit("$")))
        .when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("answer :  "), letter, F.lit(" because it fits\nmore")))
        .otherwise(F.lit("I am not sure"))
    )
    return li.select("l_orderkey", "l_linenumber", r.alias("t"))


def answer_extract_english(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = english_responses(spark, sf_dir)
    return r.select(
        "l_orderkey", "l_linenumber", X.extract_english_mcq(F.col("t")).alias("mcq"), X.extract_english_free(F.col("t")).alias("free")
    )


def extract_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers found behind whole document texts."""
    docs = S.spread(S.table(spark, sf_dir, "documents").select("doc_id", "text"))
    k = F.col("doc_id")
    letter = F.substring(F.lit("ကခဂဃ"), (k % 4 + 1).cast("int"), 1)
    answer = F.when(k % 3 == 0, F.concat(F.lit("("), letter, F.lit(")"))).when(k % 3 == 1, F.lit("မှန်")).otherwise(F.concat(F.lit("(word "), k.cast("string"), F.lit(")")))
    t = normalize_response(F.concat(F.coalesce("text", F.lit("")), F.lit("\n**အဖြေ: "), answer, F.lit("**")))
    rows = docs.select("doc_id", t.alias("t"))
    return rows.select("doc_id", X.extract_mcq(F.col("t")).alias("mcq"), X.extract_tof(F.col("t")).alias("tof"), X.extract_fib(F.col("t")).alias("fib"))


def exam_mcq_word_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiple choice whose answer is a text with regex characters, given in either case."""
    k = F.col("p_partkey")
    answer = F.concat(F.lit("["), F.col("p_brand"), F.lit(".*+?|^)"))
    given = F.when(k % 4 == 0, answer).when(k % 4 == 1, F.lower(answer)).when(k % 4 == 2, F.lit("ခ")).otherwise(F.col("p_brand"))
    rows = S.spread(S.table(spark, sf_dir, "part").select("p_partkey", "p_brand")).select(
        k.alias("item_id"), answer.alias("answer"), normalize_response(F.concat(F.lit("so\nအဖြေ : ("), given, F.lit(") end"))).alias("t")
    )
    return rows.select("item_id", X.extract_exam_mcq(F.col("t"), F.col("answer")).alias("extracted"))


# --- rubric ----------------------------------------------------------------------

def rubric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = S.grader_outputs(spark, sf_dir).withColumn("grade", parse_rubric(F.col("grade_output")))
    m = rubric_metrics(F.col("grade"))
    return g.select(
        "doc_id",
        F.col("grade.content").alias("content"),
        F.col("grade.register").alias("register"),
        F.col("grade.grammar").alias("grammar"),
        F.col("grade.valid").alias("grade_valid"),
        rubric_score(F.col("grade")).alias("score"),
        m.alias("metrics"),
    )


def rubric_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rubric_rows(spark, sf_dir)
    return r.select(
        "doc_id", "content", "register", "grammar", "grade_valid",
        F.round("score", DIGITS).alias("score"),
        F.round(F.col("metrics")["Content Relevancy"], DIGITS).alias("content_score"),
        F.round(F.col("metrics")["Register Appropriateness"], DIGITS).alias("register_score"),
        F.round(F.col("metrics")["Grammatical and Syntactic Competence"], DIGITS).alias("grammar_score"),
    )


def graded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each graded answer with its metrics as JSON text."""
    rows = S.grader_outputs(spark, sf_dir).select("doc_id", "grade_output", F.lit("SHORT_QNA").alias("type"), F.lit("").alias("answer"), F.lit("").alias("response"))
    return score_exam(rows, grade_output_col="grade_output").select("doc_id", "extracted", F.round("score", DIGITS).alias("score"), "grade_valid")


def rubric_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean/std of the SHORT_QNA metrics and score per label quality; invalid grades excluded."""
    r = rubric_rows(spark, sf_dir).join(S.table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    agg = aggregate_results(r, ["quality"])
    return agg.select(F.col("quality").cast("bigint").alias("quality"), "metric", F.round("value", DIGITS).alias("value"))


def model_graded_exam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHORT_QNA responses graded by a (stand-in) grader model, aggregated per model."""
    items = S.exam_items(spark, sf_dir).filter(F.col("type") == "SHORT_QNA").select("item_id", "type", "question", "answer")
    resp = S.model_responses(spark, sf_dir).join(items, "item_id").withColumn("response_text", normalize_response(F.col("response")))
    # The response key is not unique, so the grader call carries what scoring needs.
    carry = ["model_name", "type", "answer", "response_text"]
    grades = IO.materialize(grade_with_model(resp, rubric_chat, carry, policy=NO_RETRY, num_partitions=spread_to(spark)), "grades")
    scored = score_exam(grades.withColumn("response", F.col("response_text")), grade_output_col="grade_output")
    return _stats_out(aggregate_results(scored, ["model_name"]), EXAM)


# --- sampling --------------------------------------------------------------------

def sample_fixed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = S.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sample_fixed(docs, "doc_id", SAMPLE_N, SEED)


def debug_head_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debug_head(S.table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", 5)


# --- template generation ----------------------------------------------------------

def _explode_messages(df: DataFrame) -> DataFrame:
    return df.select("row_key", "group_id", "template_id", F.posexplode("messages").alias("pos", "msg")).select(
        "row_key", "group_id", "template_id", "pos", F.col("msg.role").alias("role"), F.col("msg.content").alias("content")
    )


def template_vars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template slots of whole document texts that hold some by rule, per source."""
    from ..operators.generate import corpus_variables

    k = F.col("doc_id")
    slot = F.when(k % 3 == 0, "{{lang}} {{lang}}").when(k % 3 == 1, F.concat(F.lit("{{ title }} {{v"), (k % 7).cast("string"), F.lit("}}"))).otherwise("{lang}} {{open\n}}")
    docs = S.spread(S.table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return corpus_variables(docs.select("source", F.concat("text", slot).alias("text")), "text", "source")


def template_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = generate(S.dictionary(spark, sf_dir), DEFAULT_TEMPLATE_GROUPS, "row_key", SEED)
    return _explode_messages(accepted)


def template_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = generate(S.dictionary(spark, sf_dir), DEFAULT_TEMPLATE_GROUPS, "row_key", SEED)
    return rejected


def template_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejections by reason; the column of one variable is missing."""
    _, rejected = generate(S.dictionary(spark, sf_dir).drop("origin"), DEFAULT_TEMPLATE_GROUPS, "row_key", SEED)
    return reject_counts(rejected)


def dictionary_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary file with other columns and another order, read by name and generated from."""
    path = scratch_path(spark, "dictionary_csv")
    words = S.dictionary(spark, sf_dir)
    IO.write_csv(words.select(F.lit("x,\"y\"\nz").alias("note"), "origin", "word", "meaning", "pos", "phonetics", F.col("row_key").cast("string").alias("row_key")), path)
    names = ["row_key", "word", "phonetics", "meaning", "pos", "origin"]
    rows = fill_missing(IO.read_csv(spark, path, names), names[1:]).withColumn("row_key", F.col("row_key").cast("bigint"))
    accepted, _ = generate(rows, DEFAULT_TEMPLATE_GROUPS, "row_key", SEED)
    return _explode_messages(accepted)


def sft_jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = generate(S.dictionary(spark, sf_dir), DEFAULT_TEMPLATE_GROUPS, "row_key", SEED)
    path = scratch_path(spark, "sft_jsonl")
    accepted.select("row_key", "group_id", "template_id", "messages").write.json(path)
    back = spark.read.schema("row_key bigint, group_id int, template_id int, messages array<struct<role:string,content:string>>").json(path)
    return _explode_messages(back)


# --- distillation -----------------------------------------------------------------

def distil_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.distil import ensure_output, pending_rows

    df = ensure_output(S.distil_input(spark, sf_dir), "output")
    return pending_rows(df, "output").select("row_key")


def distil_prompt_alpaca(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.distil_input(spark, sf_dir)
    return df.select("row_key", alpaca_prompt(df).alias("prompt"))


def distil_prompt_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = S.distil_input(spark, sf_dir)
    return df.select("row_key", simple_prompt(df).alias("prompt"))


def _distil(spark, sf_dir, chat=echo_chat, results_path=None):
    df = S.distil_input(spark, sf_dir)
    return run_distillation(
        df, chat, key_col="row_key", formatter=alpaca_prompt, results_path=results_path, policy=NO_RETRY, n_chunks=2, num_partitions=spread_to(spark)
    )


def distil_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _distil(spark, sf_dir).final.select("row_key", "output")


def distil_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _distil(spark, sf_dir).stats


def distil_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _distil(spark, sf_dir).errors.select(F.col("key").cast("bigint").alias("row_key"), "error", "detail")


def distil_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run against a flaky model, then a rerun: only unfinished rows are called."""
    path = scratch_path(spark, "distil_resume")
    _distil(spark, sf_dir, flaky_chat, path)
    return _distil(spark, sf_dir, echo_chat, path).stats


def distil_null_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input without an output column, and a formatter that gives no prompt for some rows:
    these are error rows. Then the same input again, overwritten: every row is called anew."""
    df = S.distil_input(spark, sf_dir).drop("output")
    path = scratch_path(spark, "distil_null")
    more = dict(key_col="row_key", formatter=F.when(F.col("row_key") % 4 != 0, F.col("instruction")), results_path=path, policy=NO_RETRY, n_chunks=2, num_partitions=spread_to(spark))
    first = run_distillation(df, echo_chat, **more)
    again = run_distillation(first.final, echo_chat, overwrite=True, **more)
    return first.stats.select(F.lit("first").alias("run"), "*").unionByName(again.stats.select(F.lit("overwrite").alias("run"), "*"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distillation input through the CSV sink and back (quoted newlines, spaces kept)."""
    df = S.distil_input(spark, sf_dir)
    path = scratch_path(spark, "csv")
    IO.write_csv(df.select(F.col("row_key").cast("string").alias("row_key"), "instruction", "input", "output"), path)
    back = IO.read_csv(spark, path, ["row_key", "instruction", "input", "output"])
    return back.select(F.col("row_key").cast("bigint").alias("row_key"), "instruction", "input", "output")


# --- metrics files and reports ------------------------------------------------------

def metrics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = both_metrics(spark, sf_dir)
    root = scratch_path(spark, "metrics")
    IO.write_metrics(metrics, root)
    back = IO.read_metrics(spark, root)
    return back.select("eval_name", "model_name", "metric", "value")


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report lines of the exam evaluation: the responses are scored once, and both the
    statistics and the examples (ordered by a text id) come from the scored rows."""
    scored = exam_scored(spark, sf_dir, more=QUESTION_COLUMNS)
    scored = IO.materialize(scored.select("l_orderkey", "l_linenumber", "model_name", "type", "answer", *QUESTION_COLUMNS, "response_text", "extracted", "score", "metrics"), "scored")
    metrics = _stats_out(aggregate_results(scored, ["model_name"]), EXAM)
    item = F.concat(F.lit("response-to-order-line-"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"))
    return report_lines(metrics, examples_html(scored).select(F.lit(EXAM).alias("eval_name"), "model_name", item.alias("item_id"), "html"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "eval_scorecard": eval_scorecard,
        "category_metrics": category_metrics,
        "metric_stats_override": metric_stats_override,
        "leaderboard": leaderboard,
        "leaderboard_markdown": leaderboard_markdown,
        "exact_match_nullsafe": exact_match_nullsafe,
        "stream_scorecard": stream_scorecard,
        "eval_run_metrics": eval_run_metrics,
        "eval_run_leaderboard": eval_run_leaderboard,
        "eval_run_failures": eval_run_failures,
        "eval_run_rerun": eval_run_rerun,
        "retry_policies": retry_policies,
        "extract_documents": extract_documents,
        "exam_mcq_word_answer": exam_mcq_word_answer,
        "graded_rows": graded_rows,
        "template_reject_counts": template_reject_counts,
        "dictionary_csv": dictionary_csv,
        "distil_null_prompts": distil_null_prompts,
        "judge_equality": judge_equality,
        "multimodal_parts": multimodal_parts,
        "mcq_prompt_4": mcq_prompt_4,
        "typed_prompt": typed_prompt_q,
        "type_filter": type_filter,
        "chat_pack": chat_pack,
        "convo_assemble": convo_assemble,
        "message_html": message_html_q,
        "example_html": example_html_q,
        "grader_prompt": grader_prompt_q,
        "judge_prompt": judge_prompt_q,
        "judge_verdict": judge_verdict_q,
        "normalize_response": normalize_response_q,
        "answer_extract_mcq": answer_extract_mcq,
        "answer_extract_tof": answer_extract_tof,
        "answer_extract_fib": answer_extract_fib,
        "answer_extract_open": answer_extract_open,
        "answer_extract_english": answer_extract_english,
        "rubric_scores": rubric_scores,
        "rubric_aggregate": rubric_aggregate,
        "model_graded_exam": model_graded_exam,
        "sample_fixed": sample_fixed_q,
        "debug_head": debug_head_q,
        "template_vars": template_vars,
        "template_generate": template_generate,
        "template_rejects": template_rejects,
        "sft_jsonl_roundtrip": sft_jsonl_roundtrip,
        "distil_pending": distil_pending,
        "distil_prompt_alpaca": distil_prompt_alpaca,
        "distil_prompt_simple": distil_prompt_simple,
        "distil_merge": distil_merge,
        "distil_stats": distil_stats,
        "distil_errors": distil_errors,
        "distil_resume": distil_resume,
        "csv_roundtrip": csv_roundtrip,
        "metrics_roundtrip": metrics_roundtrip,
        "report_rows": report_rows,
    }
