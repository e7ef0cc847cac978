"""A content-addressed store of model replies: equal requests are called once.

A request is known by a hash of the model's name, the messages and the name of the call
settings.  Replies are appended to one table under that hash, so the same prompt is paid
for once, whatever item, evaluation or run asks for it, and a rerun under new ids calls
nothing again.  Failed calls are stored too and tried again by the next run.

Requests are made distinct before the call (partial aggregation first: a prompt that a
third of all rows share is one row per task before the shuffle).  Replies go back to the
rows by a join on the hash; requests that more than one in ``HOT_REQUESTS`` of all rows
share (so fewer than ``HOT_REQUESTS``) are joined by a broadcast, the others by Spark's
own choice, so a hot prompt is not one task's work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.io import path_exists
from .inference import CallPolicy, batch_chat, call_in_rounds

REPLY_SCHEMA = "request string, model_name string, response string, error string, attempts int, call_time timestamp"
#: Requests shared by more than one in so many rows are joined by a broadcast.
HOT_REQUESTS = 1000
#: Replies are saved after each of so many parts of the work list.
DEFAULT_CHUNKS = 10


def request_key(model_name: Column, messages: Column, settings: str = "") -> Column:
    """The hash that names a request."""
    return F.sha2(F.to_json(F.struct(model_name.alias("model"), messages.alias("messages"), F.lit(settings).alias("settings"))), 256)


def stored_replies(spark: SparkSession, path: str) -> DataFrame:
    """Every reply ever stored; empty before the first."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], REPLY_SCHEMA)
    return spark.read.schema(REPLY_SCHEMA).parquet(path)


def best_replies(replies: DataFrame) -> DataFrame:
    """One reply per request: a good one if there is any, else the latest error."""
    best = F.max_by(F.struct("response", "error", "attempts"), F.struct(F.col("error").isNull(), "call_time"))
    return replies.groupBy("request").agg(best.alias("r")).select("request", "r.*")


def call_stored(
    requests: DataFrame,
    samplers: dict[str, Callable[[list[dict]], str]],
    path: str | None = None,
    messages_col: str = "prompt_messages",
    policy: CallPolicy | None = None,
    concurrency: int = 1,
    num_partitions: int | None = None,
    n_chunks: int = DEFAULT_CHUNKS,
    settings: str = "",
    rounds: bool = False,
) -> DataFrame:
    """The rows of ``requests`` (any columns, with ``model_name`` and messages) with the
    columns ``response``, ``error`` and ``attempts`` of their reply.

    Every row comes back exactly once, whatever ids repeat or are null.  The rows are written
    once; the work list, distinct requests without a good reply in the store at ``path``, is
    written by chunk, and each chunk's replies are appended before the next starts. With
    ``rounds`` failed calls are tried again by later jobs (``call_in_rounds``).
    """
    call = call_in_rounds if rounds else batch_chat
    spark = requests.sparkSession
    path = path or scratch_path(spark, "replies")
    clash = {"__request", "response", "error", "attempts"}.intersection(requests.columns)
    if clash:
        raise ValueError(f"requests have columns of the reply already: {', '.join(sorted(clash))}")
    keyed = requests.withColumn("__request", request_key(F.col("model_name"), F.col(messages_col), settings))
    rows_path = scratch_path(spark, "requests")
    keyed.write.parquet(rows_path)
    keyed = spark.read.schema(keyed.schema).parquet(rows_path)
    distinct = keyed.groupBy(F.col("__request").alias("request")).agg(F.first("model_name").alias("model_name"), F.first(messages_col).alias("messages"), F.count(F.lit(1)).alias("n_rows"))
    distinct = distinct.withColumn("__chunk", F.pmod(F.xxhash64("request"), F.lit(n_chunks)).cast("int"))
    good = stored_replies(spark, path).filter(F.col("error").isNull()).select("request").distinct()
    todo_path = scratch_path(spark, "distinct_requests")
    distinct.join(good.withColumn("known", F.lit(True)), "request", "left").write.partitionBy("__chunk").parquet(todo_path)
    work = spark.read.schema("request string, model_name string, messages " + requests.schema[messages_col].dataType.simpleString() + ", n_rows bigint, known boolean, __chunk int").parquet(todo_path)
    for chunk in range(n_chunks):
        part = work.filter((F.col("__chunk") == chunk) & F.col("known").isNull())
        out = call(part, samplers, ["request", "model_name"], model_col="model_name", policy=policy, concurrency=concurrency, num_partitions=num_partitions)
        out.withColumn("call_time", F.current_timestamp()).write.mode("append").parquet(path)
    replies = best_replies(stored_replies(spark, path).join(work.select("request"), "request", "left_semi"))
    return _fanned_out(keyed, replies, work)


def _fanned_out(keyed: DataFrame, replies: DataFrame, work: DataFrame) -> DataFrame:
    """The reply of each row, by a broadcast for hot requests."""
    n_rows = work.agg(F.sum("n_rows")).first()[0] or 0
    # fewer than HOT_REQUESTS by their definition
    is_hot = F.col("n_rows") * HOT_REQUESTS > n_rows
    hot = F.broadcast(work.filter(is_hot).select(F.col("request").alias("__request")))
    by_key = replies.withColumnRenamed("request", "__request")
    parts = [
        keyed.join(hot, "__request", "left_semi").join(F.broadcast(by_key.join(hot, "__request", "left_semi")), "__request"),
        keyed.join(hot, "__request", "left_anti").join(by_key.join(hot, "__request", "left_anti"), "__request"),
    ]
    return parts[0].unionByName(parts[1]).drop("__request")
