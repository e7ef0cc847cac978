"""batch_chat retries and errors; resumable distillation invariants."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from gradeflow.fixed_values import BAD_REQUEST_TEXT, EMPTY_PROMPT_ERROR
from gradeflow.operators.distil import run_distillation
from gradeflow.operators.inference import CallPolicy, bad_request_fallback, batch_chat, retry_rate_limit
from gradeflow.operators.prompts import alpaca_prompt, pack_messages
from gradeflow.session import scratch_path
from gradeflow.sources import io as IO
from gradeflow.sources import standins as S


def _msgs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, t string").select(
        "k", pack_messages(F.col("t"), system="sys").alias("messages")
    )


def always_fail(messages):
    raise RuntimeError("boom")


def rate_limited(messages):
    raise RuntimeError("Rate limit reached")


class BadRequestError(Exception):
    pass


def bad_request(messages):
    raise BadRequestError("bad")


def echo(messages):
    assert messages[0]["role"] == "system"
    return messages[-1]["content"].upper()


def test_batch_chat_ok_and_bounded_retries(spark):
    df = _msgs(spark, ["a", "b"])
    ok = {r["k"]: r for r in batch_chat(df, echo, ["k"]).collect()}
    assert ok[0]["response"] == "A" and ok[0]["error"] is None and ok[0]["attempts"] == 1
    pol = CallPolicy(max_attempts=3, backoff_base=0)
    bad = batch_chat(df, always_fail, ["k"], policy=pol).collect()
    assert all(r["response"] is None and r["error"] == "boom" and r["attempts"] == 3 for r in bad)
    # retry only on rate limits: other errors stop at once
    pol2 = CallPolicy(max_attempts=4, backoff_base=0, retryable=retry_rate_limit)
    assert [r["attempts"] for r in batch_chat(df, always_fail, ["k"], policy=pol2).collect()] == [1, 1]
    assert [r["attempts"] for r in batch_chat(df, rate_limited, ["k"], policy=pol2).collect()] == [4, 4]
    pol3 = CallPolicy(max_attempts=2, backoff_base=0, fallback=bad_request_fallback)
    assert {r["response"] for r in batch_chat(df, bad_request, ["k"], policy=pol3).collect()} == {BAD_REQUEST_TEXT}


def test_batch_chat_routes_models_and_threads(spark):
    df = _msgs(spark, ["a", "b", "c"]).select(F.explode(F.array(F.lit("m1"), F.lit("m2"))).alias("model"), "*")
    chats = {"m1": lambda m: "one", "m2": lambda m: "two"}
    out = batch_chat(df, chats, ["model", "k"], model_col="model", concurrency=3, num_partitions=2).collect()
    assert {(r["model"], r["response"]) for r in out} == {("m1", "one"), ("m2", "two")}
    assert len(out) == 6


def length_chat(messages):
    n = len(messages[-1]["content"])
    if n % 7 == 3:
        raise ValueError("synthetic failure")
    return f"  reply {n}\n"


def test_distillation_invariants_and_resume(spark):
    df = S.distil_input(spark, SF_SMALL)
    path = scratch_path(spark, "distil_test")
    pol = CallPolicy(max_attempts=2, backoff_base=0, retryable=retry_rate_limit)
    r1 = run_distillation(df, length_chat, formatter=alpaca_prompt, results_path=path, policy=pol, n_chunks=3)
    s1 = r1.stats.collect()[0]
    assert s1["processed"] + s1["errors"] + s1["skipped"] == s1["total_rows"] == df.count()
    assert s1["errors"] == r1.errors.count() > 0
    filled = r1.final.filter(F.col("output").startswith("reply ")).count()
    assert filled == s1["processed"]
    # A rerun calls only the failed rows; a run without failures then calls nothing.
    r2 = run_distillation(df, length_chat, formatter=alpaca_prompt, results_path=path, policy=pol)
    s2 = r2.stats.collect()[0]
    assert s2["calls"] == s1["errors"] and s2["processed"] == 0
    # overwrite starts a new run: every row is pending again
    r3 = run_distillation(df, length_chat, formatter=alpaca_prompt, results_path=path, policy=pol, overwrite=True)
    assert r3.stats.collect()[0]["skipped"] == 0


def test_distillation_empty_prompt_and_debug(spark):
    df = spark.createDataFrame([(1, None, None), (2, "hi", None), (3, "x", "done")], "row_key long, input string, output string")
    r = run_distillation(df, length_chat, policy=CallPolicy(max_attempts=1, backoff_base=0))
    errs = {x["key"]: x["error"] for x in r.errors.collect()}
    assert errs == {"1": EMPTY_PROMPT_ERROR}
    out = {x["row_key"]: x["output"] for x in r.final.collect()}
    assert out[2] == "reply 2" and out[3] == "done" and out[1] is None
    r5 = run_distillation(S.distil_input(spark, SF_SMALL), length_chat, debug=True, formatter=alpaca_prompt)
    assert r5.stats.collect()[0]["total_rows"] == 5


def test_csv_sink_keeps_spaces_and_newlines(spark):
    df = spark.createDataFrame([("1", "a\nb", "  ", 'q"q'), ("2", "NA", None, "")], "k string, a string, b string, c string")
    path = scratch_path(spark, "csv_test")
    IO.write_csv(df, path)
    back = {r["k"]: r for r in IO.read_csv(spark, path, ["k", "a", "b", "c"]).collect()}
    assert back["1"]["a"] == "a\nb" and back["1"]["b"] == "  " and back["1"]["c"] == 'q"q'
    assert back["2"]["a"] is None and back["2"]["b"] is None and back["2"]["c"] is None


def test_content_keys_share_one_call(spark):
    rows = [("same text", None)] * 30 + [("other", None)]
    df = spark.createDataFrame(rows, "input string, output string")
    r = run_distillation(df, length_chat, key_col=None, policy=CallPolicy(max_attempts=1, backoff_base=0))
    s = r.stats.collect()[0]
    assert s["calls"] == 2 and r.final.filter(F.col("output").startswith("reply")).count() == 31


def counted(path):
    def chat(messages):
        with open(path, "a") as f:
            f.write("x\n")
        return "yes"

    return chat


def test_building_a_plan_starts_no_job_and_each_row_is_called_once(spark, tmp_path):
    from gradeflow.operators.grade import equality_judge

    sc = spark.sparkContext
    left = spark.range(40).select(F.col("id").alias("k"), F.lit("a").alias("x"))
    right = spark.range(40).select(F.col("id").alias("k"), F.lit("b").alias("y"))
    sc.setJobGroup("plan-only", "plan-only")
    try:
        out = equality_judge(left.join(right, "k"), counted(str(tmp_path / "calls")), ["k"], "x", "y")
        assert not sc.statusTracker().getJobIdsForGroup("plan-only") and not (tmp_path / "calls").exists()
        assert len(out.collect()) == 40
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len((tmp_path / "calls").read_text().split()) == 40


def test_repeated_keys_are_refused_and_null_prompts_are_errors(spark):
    import pytest

    df = spark.createDataFrame([(1, "a", None), (1, "b", None), (2, "c", None)], "row_key long, input string, output string")
    with pytest.raises(ValueError, match="'1' x 2"):
        run_distillation(df, length_chat)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "row_key long, input string")
    r = run_distillation(rows, length_chat, formatter=F.when(F.col("row_key") == 2, F.col("input")), n_chunks=2)
    assert {x["key"]: x["error"] for x in r.errors.collect()} == {"1": EMPTY_PROMPT_ERROR}
    s = r.stats.first()
    assert (s.total_rows, s.processed, s.errors, s.skipped, s.calls) == (2, 1, 1, 0, 1)


def test_runs_keep_their_own_results_and_the_latest_call_wins(spark):
    df = spark.createDataFrame([(1, "a", None)], "row_key long, input string, output string")
    path = scratch_path(spark, "runs")
    run_distillation(df, lambda m: "zz", results_path=path, run_id="one", n_chunks=1)
    run_distillation(df, lambda m: "aa", results_path=path, run_id="two", n_chunks=1)
    again = run_distillation(df, lambda m: "never", results_path=path, run_id="two", n_chunks=1)
    assert again.final.first().output == "aa" and again.stats.first().calls == 0


def test_csv_by_name_and_bad_rows(spark, tmp_path):
    import pytest

    f = tmp_path / "a.csv"
    f.write_text('row_key,instruction,input,extra\n1,"say ""hi""\nnow",x,1\n2,b,y,2\n')
    rows = IO.read_csv(spark, str(f), ["row_key", "input", "instruction"]).collect()
    assert [tuple(r) for r in rows] == [("1", "x", 'say "hi"\nnow'), ("2", "y", "b")]
    with pytest.raises(ValueError, match="no column answer"):
        IO.read_csv(spark, str(f), ["answer"])
    bad = tmp_path / "b.csv"
    bad.write_text("a,b\n1,2,3\n4\n5,6\n")
    with pytest.raises(Exception):
        IO.read_csv(spark, str(bad)).collect()
    good, rejects = IO.read_csv_parts(spark, str(bad), multi_line=False)
    assert [tuple(r) for r in good.collect()] == [("5", "6")] and sorted(r.record for r in rejects.collect()) == ["1,2,3", "4"]


def test_scratch_needs_a_shared_folder_off_local_mode(spark, monkeypatch):
    import pytest

    from gradeflow import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(type("S", (), {"sparkContext": Context()})())
