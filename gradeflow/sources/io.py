"""Readers and writers: CSV (quoted newlines), JSONL, metrics JSON, HTML text, parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import NA_STRINGS
from ..session import scratch_path
from .positions import in_order

CSV_READ_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    # Every cell is parsed, and each file's header compared, whatever columns are used.
    "columnPruning": "false",
    "enforceSchema": "false",
}
BAD_RECORD = "_corrupt_record"
CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _csv_rows(spark: SparkSession, path: str, multi_line: bool, mode: str) -> tuple[DataFrame, list[str]]:
    """All columns as text by their header names, and those names; one line is read for them."""
    reader = spark.read.options(**CSV_READ_OPTIONS).option("multiLine", str(multi_line).lower())
    names = reader.csv(path).columns
    fields = [T.StructField(c, T.StringType()) for c in names]
    if mode == "PERMISSIVE":
        fields.append(T.StructField(BAD_RECORD, T.StringType()))
    return reader.schema(T.StructType(fields)).option("mode", mode).option("columnNameOfCorruptRecord", BAD_RECORD).csv(path), names


def _nothing_of(other: str) -> Column:
    """An empty text that uses a column: Spark refuses queries of the bad-record column alone."""
    return F.left(F.coalesce(F.col(other), F.lit("")), F.lit(0))


def _record(other: str) -> Column:
    return F.concat(F.col(BAD_RECORD), _nothing_of(other))


def named_columns(names: Sequence[str], columns: Sequence[str] | None, path: str) -> list[str]:
    missing = [c for c in columns or [] if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)} (it has {', '.join(names)})")
    return list(columns or names)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, na_values: Sequence[str] = NA_STRINGS, multi_line: bool = True) -> DataFrame:
    """CSV of strings with a header; quoted newlines and doubled quotes kept.

    ``columns`` are chosen by header name, in any order of the file; a missing one is an
    error, and so is a row with too many or too few cells (see ``read_csv_parts``). The given
    missing-value strings become null. A file is one task here; ``csv_split.read_csv_split``
    reads large files by several tasks, quoted newlines included.
    """
    rows, names = _csv_rows(spark, path, multi_line, "FAILFAST")
    return na_to_null(rows.select(*named_columns(names, columns, path)), na_values)


def read_csv_parts(spark: SparkSession, path: str, columns: Sequence[str] | None = None, na_values: Sequence[str] = NA_STRINGS, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """As ``read_csv``, but rows that do not fit the header go to a second table ``(record)``."""
    rows, names = _csv_rows(spark, path, multi_line, "PERMISSIVE")
    good = rows.filter(F.col(BAD_RECORD).isNull() & (_nothing_of(names[0]) == "")).select(*named_columns(names, columns, path))
    return na_to_null(good, na_values), rows.filter(F.col(BAD_RECORD).isNotNull()).select(_record(names[0]).alias("record"))


def na_to_null(df: DataFrame, na_values: Sequence[str] = NA_STRINGS) -> DataFrame:
    nas = list(na_values)
    return df.select(
        *[
            F.when(F.col(f.name).isin(nas), F.lit(None)).otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", order: Sequence[str] = ()) -> None:
    """CSV keeping leading/trailing spaces; a null reads back as missing. With ``order`` the
    part files, read by name, hold the rows in that order."""
    (in_order(df, *order) if order else df).write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Benchmark scan (parquet / json / csv); a split is a path or a partition filter."""
    if fmt == "csv":
        return read_csv(spark, path)
    return spark.read.format(fmt).load(path)


def write_sft_jsonl(df: DataFrame, path: str, messages_col: str = "messages", mode: str = "errorifexists", order: Sequence[str] = ()) -> None:
    """One ``{"messages": [...]}`` object per line, non-ASCII written as is. With ``order``
    the part files, read by name, hold the records in that order."""
    (in_order(df, *order) if order else df).select(F.col(messages_col).alias("messages")).write.mode(mode).json(path)


def read_sft_jsonl(spark: SparkSession, path: str) -> DataFrame:
    schema = "messages array<struct<role:string,content:string>>"
    return spark.read.schema(schema).json(path)


def write_metrics(metrics_long: DataFrame, root: str) -> None:
    """Long metrics ``(eval_name, model_name, [run_mode], metric, value)`` as JSON, one
    folder per (run mode, eval, model); a rerun replaces its own folders only."""
    parts = [c for c in ("run_mode", "eval_name", "model_name") if c in metrics_long.columns]
    metrics_long.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).json(root)


def _metrics_files(spark: SparkSession, root: str, run_mode: str | None) -> DataFrame:
    schema = T.StructType([*METRICS_SCHEMA.fields, T.StructField(BAD_RECORD, T.StringType())])
    rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", BAD_RECORD).json(root)
    return rows.filter(F.col("run_mode") == run_mode) if run_mode else rows


def read_metrics(spark: SparkSession, root: str, run_mode: str | None = None) -> DataFrame:
    """Re-read metrics files, of one run mode if named; see ``metrics_rejects`` for the rest."""
    rows = _metrics_files(spark, root, run_mode)
    return rows.filter(F.col(BAD_RECORD).isNull() & (_nothing_of("metric") == "")).drop(BAD_RECORD)


def metrics_rejects(spark: SparkSession, root: str, run_mode: str | None = None) -> DataFrame:
    """(file, record): the lines of metrics files that could not be read."""
    rows = _metrics_files(spark, root, run_mode).withColumn("file", F.input_file_name())
    return rows.filter(F.col(BAD_RECORD).isNotNull()).select("file", _record("metric").alias("record"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds anything, asked of its own file system; other errors rise."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def materialize(df: DataFrame, name: str, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Write to parquet under the checkpoint root and read back (cuts lineage, so
    model calls upstream run once, and a lost executor does not redo them). ``compression``
    is that of the parquet writer, if not the session's own."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path, compression=compression)
    return spark.read.parquet(path)
