"""End-to-end: 2 models x 2 evals with stand-in chat functions; metrics, reports, leaderboard."""

import glob

from pyspark.sql import functions as F

from conftest import SF_SMALL
from gradeflow.plans.evals import run
from gradeflow.session import scratch_path
from gradeflow.sources import io as IO
from gradeflow.sources import standins as S


def always_a(messages):
    return "thinking...\nအဖြေ: (က)"


def always_true(messages):
    return "**အဖြေ: မှန်**"


def grader(messages):
    return "Content Relevancy: 3\nRegister Appropriateness: 3\nGrammatical and Syntactic Competence: 5"


def test_run_two_models_two_evals(spark):
    items = {"mmlu_lite": S.mmlu_items(spark, SF_SMALL), "mg12l": S.exam_items(spark, SF_SMALL), "bogus": None}
    root = scratch_path(spark, "run")
    res = run({"a": always_a, "t": always_true}, items, grader=grader, exam_types=None, examples=60, out_root=root)
    board = {r["model_name"]: r for r in res.leaderboard.collect()}
    assert set(board) == {"a", "t"}
    assert set(res.leaderboard.columns) == {"model_name", "mmlu_lite", "mg12l"}
    # model 'a' always answers A: the MMLU score is the share of items whose answer is A
    mm = S.mmlu_items(spark, SF_SMALL)
    assert 0 < board["a"]["mmlu_lite"] < 1
    assert board["t"]["mmlu_lite"] == 0.0
    m = {(r["eval_name"], r["model_name"], r["metric"]): r["value"] for r in res.metrics.collect()}
    assert m[("mg12l", "a", "SHORT_QNA")] == 1.0  # perfect rubric from the grader
    assert ("mmlu_lite", "a", "score:std") in m
    assert res.examples.filter(F.col("eval_name") == "mmlu_lite").count() == 2 * 60
    lines = [r["line"] for r in res.markdown.orderBy("line_no", "row_key").collect()]
    assert lines[0].startswith("| model_name |") and len(lines) == 4
    back = IO.read_metrics(spark, f"{root}/metrics")
    assert back.count() == res.metrics.count()
    assert len(glob.glob(f"{root}/reports/run_mode=full/eval_name=*/model_name=*/part-*")) >= 4
    assert mm.count() > 60


def test_run_without_known_evals_returns_none(spark):
    assert run({"a": always_a}, {"nope": None}) is None


def test_headline_prefers_f1_and_error_summary(spark):
    from gradeflow.operators.aggregate import headline
    from gradeflow.operators.distil import error_summary

    m = spark.createDataFrame(
        [("e", "a", "score", 0.5), ("e", "a", "f1_score", 0.7), ("e", "b", "score", 0.25)],
        "eval_name string, model_name string, metric string, value double",
    )
    got = {r["model_name"]: r["metric"] for r in headline(m).collect()}
    assert got == {"a": 0.7, "b": 0.25}
    errs = spark.createDataFrame([(str(i), "x") for i in range(25)], "key string, error string")
    head, total = error_summary(errs, 10)
    assert head.count() == 10 and total.collect()[0]["total_errors"] == 25


def test_fill_missing_and_short_qna_json(spark):
    from gradeflow.operators.evaluate import score_exam
    from gradeflow.operators.generate import fill_missing

    df = spark.createDataFrame([(None, "x")], "word string, pos string")
    assert fill_missing(df, ["word", "origin"]).collect()[0]["word"] == ""
    g = "Content Relevancy: 3\nRegister Appropriateness: 0\nGrammatical and Syntactic Competence: 5"
    rows = spark.createDataFrame([("SHORT_QNA", "ans", "resp", g)], "type string, answer string, response string, g string")
    r = score_exam(rows, grade_output_col="g").collect()[0]
    assert r["score"] == (1.0 + 0.0 + 1.0) / 3.0 and r["grade_valid"] is True
    import json

    assert json.loads(r["extracted"])["Register Appropriateness"] == 0.0
    assert json.dumps(json.loads(r["extracted"])) == r["extracted"]


def flaky_mcq(messages):
    n = len(messages[-1]["content"])
    if n % 3 == 0:
        raise RuntimeError("overloaded")
    return "အဖြေ: က"


def test_run_resumes_model_calls(spark):
    from gradeflow.operators.inference import CallPolicy

    items = {"mmlu_lite": S.mmlu_items(spark, SF_SMALL)}
    root = scratch_path(spark, "resume")
    pol = CallPolicy(max_attempts=1, backoff_base=0)
    r1 = run({"a": flaky_mcq}, items, out_root=root, policy=pol, n_chunks=3)
    first = spark.read.parquet(f"{root}/replies")
    failed = first.filter(F.col("error").isNotNull()).count()
    assert failed > 0 and first.count() == S.mmlu_items(spark, SF_SMALL).count()
    r2 = run({"a": always_a}, items, out_root=root, policy=pol)
    both = spark.read.parquet(f"{root}/replies")
    assert both.count() == first.count() + failed  # only the failed pairs were called again
    assert r2.examples.filter(F.col("error").isNotNull()).count() == 0
    assert r1.examples.count() == r2.examples.count()


def test_leaderboard_rejects_duplicates(spark):
    import pytest

    from gradeflow.operators.aggregate import leaderboard

    m = spark.createDataFrame(
        [("e", "a", "score", 0.5), ("e", "a", "score", 0.7)], "eval_name string, model_name string, metric string, value double"
    )
    with pytest.raises(Exception, match="duplicate headline"):
        leaderboard(m, ["e"]).collect()


def test_report_files_are_in_order(spark):
    import os

    from gradeflow.operators.report import EXAMPLE_END, REPORT_HEAD, REPORT_TAIL

    items = {"mmlu_lite": S.mmlu_items(spark, SF_SMALL)}
    root = scratch_path(spark, "report_order")
    run({"a": always_a}, items, out_root=root, examples=40)
    folder = f"{root}/reports/run_mode=full/eval_name=mmlu_lite/model_name=a"
    lines = []
    for name in sorted(f for f in os.listdir(folder) if f.startswith("part-")):
        with open(os.path.join(folder, name), encoding="utf-8") as fh:
            lines += fh.read().splitlines()
    assert lines[0] == REPORT_HEAD and lines[-1] == "</section>" + REPORT_TAIL
    assert lines.index("<section><h1>Answers</h1>") < len(lines) - 41
    assert sum(1 for x in lines if x.endswith(EXAMPLE_END)) == 40


def test_empty_inputs_give_empty_results(spark):
    from gradeflow.operators.inference import batch_chat
    from gradeflow.operators.prompts import pack_messages

    empty = spark.createDataFrame([], "k long, t string").select("k", pack_messages(F.col("t")).alias("messages"))
    out = batch_chat(empty, always_a, ["k"])
    assert out.count() == 0 and out.columns == ["k", "response", "error", "attempts"]
    items = {"mmlu_lite": S.mmlu_items(spark, SF_SMALL).limit(0)}
    res = run({"a": always_a}, items)
    assert res.metrics.count() == 0 and res.examples.count() == 0


def down(messages):
    raise RuntimeError("down")


def no_grade(messages):
    return "no scores here"


def test_failures_are_counted_and_failed_models_stay(spark):
    import pytest

    from gradeflow.operators.inference import CallPolicy

    items = {"mg12l": S.exam_items(spark, SF_SMALL)}
    pol = CallPolicy(max_attempts=1, backoff_base=0)
    root = scratch_path(spark, "failures")
    res = run({"a": always_a, "d": down}, items, grader=no_grade, exam_types=["MCQ", "SHORT_QNA"], policy=pol, out_root=root)
    counts = {r.model_name: r for r in res.counts.collect()}
    n, short = counts["a"].n_rows, items["mg12l"].filter("type = 'SHORT_QNA'").count()
    assert (counts["a"].n_errors, counts["a"].n_invalid_grades) == (0, short) and (counts["d"].n_errors, counts["d"].n_rows) == (n, n)
    board = {r.model_name: r.mg12l for r in res.leaderboard.collect()}
    assert board["d"] is None and board["a"] is not None
    report = spark.read.text(f"{root}/reports/run_mode=full/eval_name=mg12l/model_name=d").collect()
    assert sum("<!DOCTYPE" in r.value for r in report) == 1
    with pytest.raises(RuntimeError, match="failures"):
        run({"a": always_a}, items, grader=no_grade, exam_types=["SHORT_QNA"], policy=pol, strict=True)
    with pytest.raises(ValueError, match="grader"):
        run({"a": always_a}, items, exam_types=["SHORT_QNA"])
    with pytest.raises(ValueError, match="no questions"):
        run({"a": always_a}, items, language="EN-US")


def test_a_changed_prompt_is_asked_again(spark):
    items = S.mmlu_items(spark, SF_SMALL).limit(30)
    root = scratch_path(spark, "prompts")
    run({"a": always_a}, {"mmlu_lite": items}, out_root=root)
    changed = items.withColumn("question", F.when(F.col("item_id") % 2 == 0, F.lit("new?")).otherwise(F.col("question")))
    res = run({"a": always_true}, {"mmlu_lite": changed}, out_root=root)
    got = {r.item_id: r.response_text for r in res.examples.collect()}
    assert len(got) == 30 and all(("မှန်" in t) == (i % 2 == 0) for i, t in got.items())


def test_report_orders_long_ids_and_needs_no_metrics(spark):
    from gradeflow.operators.report import report_lines

    ids = [f"benchmark-row-{'0' * 12}-{i:03d}" for i in (2, 1, 3)]
    ex = spark.createDataFrame([("e", "m", i, "<article>" + i) for i in ids], "eval_name string, model_name string, item_id string, html string")
    none = spark.createDataFrame([], "eval_name string, model_name string, metric string, value double")
    rows = sorted(report_lines(none, ex).collect(), key=lambda r: (r.section, r.ord, r.sub))
    assert [r.ord for r in rows if r.section == 5] == sorted(ids)
    assert rows[0].section == 0 and rows[-1].section == 6 and not [r for r in rows if r.section in (1, 2, 3)]


def test_metrics_rewrite_modes_and_rejects(spark):
    m = spark.createDataFrame([("full", "e", "a", "score", 0.5), ("debug", "e", "a", "score", 0.1)], "run_mode string, eval_name string, model_name string, metric string, value double")
    root = scratch_path(spark, "metrics")
    for _ in range(2):
        IO.write_metrics(m, root)
    assert [r.value for r in IO.read_metrics(spark, root, run_mode="full").collect()] == [0.5] and IO.read_metrics(spark, root).count() == 2
    with open(f"{root}/run_mode=full/eval_name=e/model_name=a/part-bad.json", "w") as f:
        f.write("{broken\n")
    assert IO.read_metrics(spark, root).count() == 2
    assert [r.record for r in IO.metrics_rejects(spark, root).collect()] == ["{broken"]


def test_options_beyond_the_labels_are_an_error():
    import pytest

    from gradeflow.operators.prompts import mcq_prompt

    with pytest.raises(ValueError, match="5 options"):
        mcq_prompt(F.lit("q"), [F.lit(str(i)) for i in range(5)])
