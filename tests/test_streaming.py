"""Streaming wrappers: file-by-file distillation with resume, incremental scoring."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from gradeflow.operators.inference import CallPolicy
from gradeflow.operators.prompts import alpaca_prompt
from gradeflow.plans.catalog import exam_scored
from gradeflow.session import scratch_path
from gradeflow.sources import standins as S
from gradeflow.streaming.distil_stream import distil_stream, latest_scores, score_stream


def short_chat(messages):
    return "ok " + str(len(messages[-1]["content"]))


def test_distil_stream_three_files(spark):
    df = S.distil_input(spark, SF_SMALL)
    src = scratch_path(spark, "stream_in")
    for i in range(3):
        df.filter(F.col("row_key") % 3 == i).coalesce(1).write.parquet(src, mode="append")
    out = scratch_path(spark, "stream_out")
    results = scratch_path(spark, "stream_results")
    q = distil_stream(spark, src, df.schema, short_chat, out, results_path=results, formatter=alpaca_prompt, policy=CallPolicy(max_attempts=1, backoff_base=0))
    q.awaitTermination(300)
    assert q.lastProgress is not None
    final = spark.read.parquet(out)
    assert final.count() == df.count()
    pending = df.filter(F.col("output").isNull() | (F.trim(F.col("output")) == "")).count()
    assert final.filter(F.col("output").startswith("ok ")).count() == pending
    assert spark.read.parquet(results).count() == pending


def test_score_stream_matches_batch(spark):
    resp = S.model_responses(spark, SF_SMALL)
    src = scratch_path(spark, "resp_in")
    resp.repartition(3).write.parquet(src)
    items = S.exam_items(spark, SF_SMALL).filter(F.col("type").isin("MCQ", "FIB", "TOF"))
    out = scratch_path(spark, "scores")
    q = score_stream(spark, src, resp.schema, items, out)
    q.awaitTermination(300)
    got = {(r["model_name"], r["metric"]): r["sum"] / r["n"] for r in latest_scores(spark, out).collect()}
    from gradeflow.operators.aggregate import aggregate_results

    want = {(r["model_name"], r["metric"]): r["value"] for r in aggregate_results(exam_scored(spark, SF_SMALL), ["model_name"]).collect() if ":" not in r["metric"]}
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k] - want[k]) < 1e-12
