"""Structured Streaming wrappers.

``distil_stream``: distillation over files as they arrive. Each micro-batch
runs the batch job (``run_distillation``) against one shared results table, so
a restarted query neither repeats good calls nor loses finished chunks; the
stream's checkpoint records which files were done.

``score_stream``: scores arriving model responses against a static item table
(stream-static join) and keeps per-(model, metric) running sums, from which
mean and population std follow exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.aggregate import metric_values
from ..operators.distil import run_distillation
from ..operators.evaluate import score_exam
from ..operators.inference import CallPolicy
from ..operators.prompts import simple_prompt
from ..session import scratch_path


def distil_stream(
    spark: SparkSession,
    input_dir: str,
    schema: T.StructType,
    chat: Callable[[list[dict]], str],
    output_root: str,
    results_path: str | None = None,
    checkpoint_location: str | None = None,
    fmt: str = "parquet",
    max_files_per_trigger: int = 1,
    key_col: str = "row_key",
    output_column: str = "output",
    formatter: Callable[[DataFrame], Column] | Column = simple_prompt,
    run_id: str = "default",
    policy: CallPolicy | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops when the files seen at start are done."""
    results_path = results_path or scratch_path(spark, "distil_stream_results")
    checkpoint_location = checkpoint_location or scratch_path(spark, "distil_stream_ckpt")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).format(fmt).load(input_dir)

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        run_distillation(
            batch,
            chat,
            key_col=key_col,
            output_column=output_column,
            formatter=formatter,
            results_path=results_path,
            output_path=f"{output_root}/epoch={epoch_id}",
            output_mode="overwrite",  # a replayed epoch rewrites its own folder
            run_id=run_id,
            policy=policy,
        )

    writer = source.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def score_stream(
    spark: SparkSession,
    responses_dir: str,
    responses_schema: T.StructType,
    items: DataFrame,
    output_root: str,
    checkpoint_location: str | None = None,
    fmt: str = "parquet",
    max_files_per_trigger: int = 1,
    available_now: bool = True,
) -> StreamingQuery:
    """Running (model, metric) sums, a whole table per epoch below ``output_root``
    (complete mode; a replayed epoch rewrites its own folder). ``latest_scores`` reads
    the last one: mean = sum/n, std = sqrt(sum_sq/n - mean^2) (population).
    """
    checkpoint_location = checkpoint_location or scratch_path(spark, "score_stream_ckpt")
    responses = spark.readStream.schema(responses_schema).option("maxFilesPerTrigger", max_files_per_trigger).format(fmt).load(responses_dir)
    scored = score_exam(responses.join(items.select("item_id", "type", "answer"), "item_id"))
    long = metric_values(scored, ["model_name"])
    agg = long.groupBy("model_name", "metric").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("sum"), F.sum(F.col("value") * F.col("value")).alias("sum_sq")
    )

    def each_epoch(table: DataFrame, epoch_id: int) -> None:
        table.write.mode("overwrite").parquet(f"{output_root}/epoch={epoch_id}")

    writer = agg.writeStream.outputMode("complete").foreachBatch(each_epoch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def latest_scores(spark: SparkSession, output_root: str) -> DataFrame:
    """The table of the last epoch that ``score_stream`` wrote."""
    epochs = spark.read.parquet(output_root)
    last = epochs.agg(F.max("epoch").alias("epoch"))
    return epochs.join(last, "epoch", "left_semi").drop("epoch")
