"""Resumable distillation: fill blank output cells by calling a chat model.

Design (the toolkit rewrote one CSV every few completions):

* pending = output null or blank after ``str.strip`` (a filter placed *before*
  the model call: Catalyst does not push a filter below a Python map stage);
* minus keys that already have a good result of the same ``run_id`` in the
  append-only results table (``left_anti``), so a rerun only calls what is
  missing and failed rows are retried;
* calls run per chunk (``pmod(hash(key), n_chunks)``); each chunk's results are
  appended as parquet before the next starts, so a crash loses one chunk;
* the final table is the input left-joined to the good results, written to a
  new path (never over the input).

Results are written below ``run_id=...``, so a run reads its own history only. Keys must
be unique (they are counted before the first call); without a key column the content of
a row is its key, and equal rows share a call.

``distil_by_position`` fills a table without a key row by row: each row, equal or not, has
its own call and result, and the result is in the order of the input.

``distil_in_place`` fills a versioned table (``sources.versions``) where it is: after each
bucket a new version of the whole table is committed, so others read a whole table at any
time, and a rerun goes on with what is blank.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import EMPTY_PROMPT_ERROR
from ..functions.text import is_blank, py_strip
from ..session import scratch_path
from ..sources import versions as V
from ..sources.io import path_exists
from ..sources.positions import in_order, with_positions
from .inference import CallPolicy, batch_chat, call_in_rounds
from .prompts import pack_messages, simple_prompt
from .sample import debug_head

RESULT_SCHEMA = "call_id string, call_time timestamp, key string, output string, error string, attempts int"
#: Results are saved after each of so many parts of the work list.
DEFAULT_CHUNKS = 10


@dataclass
class DistilRun:
    final: DataFrame  # input rows with the output column filled where possible
    results: DataFrame  # this call's rows of the results table
    stats: DataFrame  # one row: total_rows, processed, errors, skipped, calls
    errors: DataFrame  # (key, error, detail)
    results_path: str
    run_id: str
    call_id: str


def row_key(df: DataFrame, key_col: str | None) -> Column:
    """The given key column, else sha2 over all columns (equal rows share a call)."""
    if key_col:
        return F.col(key_col).cast("string")
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)])), 256)


def ensure_output(df: DataFrame, output_column: str, overwrite: bool = False) -> DataFrame:
    """Add the output column as '' when absent; blank it when overwriting."""
    if output_column not in df.columns or overwrite:
        return df.withColumn(output_column, F.lit(""))
    return df


def pending_rows(df: DataFrame, output_column: str) -> DataFrame:
    return df.filter(is_blank(F.col(output_column)))


def run_results(spark: SparkSession, results_path: str, run_id: str) -> DataFrame:
    """The results of a run so far; empty before its first save."""
    path = f"{results_path}/run_id={run_id}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], RESULT_SCHEMA)
    return spark.read.schema(RESULT_SCHEMA).parquet(path)


def good_results(results: DataFrame) -> DataFrame:
    return results.filter(F.col("error").isNull() & ~is_blank(F.col("output")))


def done_keys(spark: SparkSession, results_path: str, run_id: str) -> DataFrame:
    """Keys of the run that already have a non-blank output and no error."""
    return good_results(run_results(spark, results_path, run_id)).select("key").distinct()


def check_keys(keyed: DataFrame, key: str = "_key", shown: int = 5) -> None:
    """Raise, naming some of them, when keys repeat or are null: results are merged by key."""
    bad = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(key).isNull())
    rows = bad.orderBy(key).limit(shown).collect()
    if rows:
        raise ValueError("keys must be unique and not null, found " + ", ".join(f"{r[0]!r} x {r[1]}" for r in rows))


def run_distillation(
    df: DataFrame,
    chat: Callable[[list[dict]], str],
    key_col: str | None = "row_key",
    output_column: str = "output",
    formatter: Callable[[DataFrame], Column] | Column = simple_prompt,
    results_path: str | None = None,
    output_path: str | None = None,
    output_mode: str = "errorifexists",
    run_id: str = "default",
    overwrite: bool = False,
    n_chunks: int = DEFAULT_CHUNKS,
    debug: bool = False,
    policy: CallPolicy | None = None,
    concurrency: int = 1,
    num_partitions: int | None = None,
    system: str | None = None,
    rounds: bool = False,
) -> DistilRun:
    """Fill blank ``output_column`` cells of ``df`` with the model's stripped reply; with
    ``rounds`` failed calls are tried again by later jobs (``call_in_rounds``)."""
    call = call_in_rounds if rounds else batch_chat
    spark = df.sparkSession
    if debug:
        df = debug_head(df, key_col, 5) if key_col else df.limit(5)
    if overwrite:
        run_id = f"{run_id}-{uuid.uuid4().hex[:12]}"
    results_path = results_path or scratch_path(spark, "distil_results")
    call_id = uuid.uuid4().hex
    df = ensure_output(df, output_column, overwrite)
    keyed = df.withColumn("_key", row_key(df, key_col))
    if key_col:
        check_keys(keyed)

    # A missing prompt is an empty one: an error row, never a silent skip.
    prompt = F.coalesce(formatter(keyed) if callable(formatter) else formatter, F.lit(""))
    todo = pending_rows(keyed, output_column).join(done_keys(spark, results_path, run_id), F.col("_key") == F.col("key"), "left_anti")
    todo = todo.select(F.col("_key").alias("key"), prompt.alias("_prompt"))
    if not key_col:
        # Content keys: equal rows (possibly a third of the table) share one call.
        # The de-duplication aggregates map-side first, so a hot key stays cheap.
        todo = todo.dropDuplicates(["key"])
    # Snapshot the work list once (later appends must not change it mid-run),
    # partitioned by chunk so each chunk's job reads only its own files.
    todo_path = scratch_path(spark, "distil_todo")
    todo = todo.withColumn("_chunk", F.pmod(F.hash("key"), F.lit(n_chunks)))
    todo.write.partitionBy("_chunk").parquet(todo_path)
    # Explicit schema: an empty work list leaves no partition folders to infer from.
    todo = spark.read.schema(todo.schema).parquet(todo_path)

    own_path = f"{results_path}/run_id={run_id}"
    meta = [F.lit(call_id).alias("call_id"), F.current_timestamp().alias("call_time")]
    empty = todo.filter(F.col("_prompt") == "").select(
        "key", F.lit(None).cast("string").alias("output"), F.lit(EMPTY_PROMPT_ERROR).alias("error"), F.lit(0).alias("attempts")
    )
    empty.select(*meta, "key", "output", "error", "attempts").write.mode("append").parquet(own_path)

    callable_rows = todo.filter(F.col("_prompt") != "").withColumn("messages", pack_messages(F.col("_prompt"), system=system))
    for chunk in range(n_chunks):
        part = callable_rows.filter(F.col("_chunk") == chunk)
        answered = call(part, chat, ["key"], policy=policy, concurrency=concurrency, num_partitions=num_partitions)
        answered.select(
            *meta,
            "key",
            F.when(F.col("error").isNull(), py_strip(F.col("response"))).alias("output"),
            "error",
            "attempts",
        ).write.mode("append").parquet(own_path)

    all_results = run_results(spark, results_path, run_id)
    mine = all_results.filter(F.col("call_id") == call_id)
    # One good output per key: the latest call wins.
    good = good_results(all_results).groupBy("key").agg(F.max_by("output", F.struct("call_time", "call_id")).alias("_new"))
    final = (
        keyed.join(good, F.col("_key") == F.col("key"), "left")
        .withColumn(
            output_column,
            F.when(is_blank(F.col(output_column)) & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col(output_column)),
        )
        .drop("_key", "key", "_new")
    )
    if output_path:
        final.write.mode(output_mode).parquet(output_path)
        final = spark.read.parquet(output_path)

    stats = distil_stats(keyed, mine, output_column)
    errors = mine.filter(F.col("error").isNotNull()).select(
        "key", "error", F.concat(F.lit("Row "), F.col("key"), F.lit(": "), F.col("error")).alias("detail")
    )
    return DistilRun(final, mine, stats, errors, results_path, run_id, call_id)


POSITION = "position"


def distil_by_position(
    rows: DataFrame,
    chat: Callable[[list[dict]], str],
    output_column: str = "output",
    output_path: str | None = None,
    **options,
) -> DistilRun:
    """Fill a table without a key: a row is known by its position and its content.

    ``rows`` are numbered once (``sources.positions``; after ``from_files`` in file order), so
    equal rows are separate calls with separate results. A rerun with the same
    ``results_path`` and ``run_id`` repeats only rows without a good result; a row whose
    content has changed at its position is called anew. ``final`` has the column
    ``position`` and, written to ``output_path``, part files in the order of the input.
    """
    key = "__position_key"
    placed = with_positions(ensure_output(rows, output_column), POSITION)
    content = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in placed.columns if c not in (POSITION, output_column)])))
    placed = placed.withColumn(key, F.concat_ws("-", F.col(POSITION).cast("string"), content))
    run = run_distillation(placed, chat, key_col=key, output_column=output_column, **options)
    final = run.final.drop(key)
    if output_path:
        in_order(final, POSITION).write.parquet(output_path)
        final = rows.sparkSession.read.schema(final.schema).parquet(output_path)
    place = F.substring_index("key", "-", 1)
    errors = run.errors.select(place.alias("key"), "error", F.concat(F.lit("Row "), place, F.lit(": "), F.col("error")).alias("detail"))
    return DistilRun(final, run.results, run.stats, errors, run.results_path, run.run_id, run.call_id)


@dataclass
class InPlaceRun:
    versions: list[int]  # the versions this run committed, in order
    errors: DataFrame  # (version, error, n): failed calls of the rows of each version's bucket
    root: str


def distil_in_place(
    spark: SparkSession,
    root: str,
    chat: Callable[[list[dict]], str],
    output_column: str = "output",
    formatter: Callable[[DataFrame], Column] | Column = simple_prompt,
    policy: CallPolicy | None = None,
    concurrency: int = 1,
    num_partitions: int | None = None,
    system: str | None = None,
    before_commit: Callable[[], None] | None = None,
) -> InPlaceRun:
    """Fill the blank cells of ``output_column`` in the versioned table at ``root``.

    Bucket by bucket the blank rows are called, the bucket is written anew with the replies,
    and a version is committed in which only that bucket differs. The rows themselves go
    through the call, so they need no key and nothing is joined; each blank row is one call.
    Buckets without a blank row are neither read again nor written. A reader always has a
    whole table: every save so far, all else as it was. A crash costs the bucket in work; a
    second writer on the same table fails at its commit.
    """
    version = V.current(spark, root)
    if output_column not in version.struct().names:
        raise ValueError(f"the table at {root} has no column {output_column!r}")
    names = version.struct().names
    committed, errors_path = [], scratch_path(spark, "in_place_errors")

    def fill(rows: DataFrame) -> DataFrame:
        blank = is_blank(F.col(output_column))
        prompt = F.coalesce(formatter(rows) if callable(formatter) else formatter, F.lit(""))
        asked = rows.filter(blank).withColumn("__prompt", prompt)
        asked = asked.withColumn("__row", F.struct(*[F.col(f"`{n}`") for n in names]))
        packed = asked.filter(F.col("__prompt") != "").select("__row", pack_messages(F.col("__prompt"), system=system).alias("messages"))
        answered = batch_chat(packed, chat, ["__row"], policy=policy, concurrency=concurrency, num_partitions=num_partitions)
        answered = answered.select("__row", F.when(F.col("error").isNull(), py_strip(F.col("response"))).alias("__new"), F.col("error").alias("__error"))
        empty = asked.filter(F.col("__prompt") == "").select("__row", F.lit(None).cast("string").alias("__new"), F.lit(EMPTY_PROMPT_ERROR).alias("__error"))
        path = scratch_path(spark, "in_place_bucket")
        answered.unionByName(empty).write.parquet(path)
        called = spark.read.schema(answered.schema).parquet(path)
        failed = called.filter(F.col("__error").isNotNull()).groupBy(F.col("__error").alias("error")).agg(F.count(F.lit(1)).alias("n"))
        failed.select(F.lit(version.number + 1).cast("bigint").alias("version"), "error", "n").write.mode("append").parquet(errors_path)
        new = F.when(F.col("__new").isNotNull() & ~is_blank(F.col("__new")), F.col("__new")).otherwise(F.col(f"__row.`{output_column}`"))
        filled = called.select(*[(new if n == output_column else F.col(f"__row.`{n}`")).alias(n) for n in names])
        return filled.unionByName(rows.filter(~blank))

    for bucket in range(version.buckets):
        if V.read_buckets(spark, version, [bucket]).filter(is_blank(F.col(output_column))).isEmpty():
            continue
        version = V.rewrite(spark, root, version, bucket, fill, before_commit)
        committed.append(version.number)
    schema = "version bigint, error string, n bigint"
    errors = spark.read.schema(schema).parquet(errors_path) if committed else spark.createDataFrame([], schema)
    return InPlaceRun(committed, errors, root)


def distil_stats(keyed: DataFrame, mine: DataFrame, output_column: str) -> DataFrame:
    """total_rows, processed, errors, skipped (per input row) and calls (per model call).

    Input rows left-joined on the key to this call's results, unioned with the
    results' attempt counts, then one aggregate.
    """
    res = mine.select(F.col("key").alias("_rk"), F.col("error").alias("_err"))
    per_row = keyed.select("_key").join(res, F.col("_key") == F.col("_rk"), "left").select(
        F.lit(True).alias("_row"), "_rk", "_err", F.lit(None).cast("int").alias("_att")
    )
    per_call = mine.select(
        F.lit(False).alias("_row"), F.lit(None).cast("string").alias("_rk"), F.lit(None).cast("string").alias("_err"), F.col("attempts").alias("_att")
    )
    both = per_row.unionByName(per_call)
    row = F.col("_row")
    return both.agg(
        F.count_if(row).alias("total_rows"),
        F.count_if(row & F.col("_rk").isNotNull() & F.col("_err").isNull()).alias("processed"),
        F.count_if(row & F.col("_err").isNotNull()).alias("errors"),
        F.count_if(row & F.col("_rk").isNull()).alias("skipped"),
        F.coalesce(F.sum("_att"), F.lit(0)).cast("bigint").alias("calls"),
    )


def error_summary(errors: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` error lines by key (a display limit) and the total count."""
    return errors.orderBy("key").limit(n), errors.agg(F.count(F.lit(1)).alias("total_errors"))
