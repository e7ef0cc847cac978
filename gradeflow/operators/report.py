"""HTML per example, HTML report rows per (eval, model), markdown leaderboard lines."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settings
from ..sources.io import materialize
from ..functions.text import as_col, html_escape, message_html, py_str, score_display

REPORT_HEAD = (
    "<!DOCTYPE html><html lang=\"my\"><head><meta charset=\"utf-8\"><title>Evaluation report</title><style>"
    "body{font-family:sans-serif;margin:2em auto;max-width:60em}"
    "section[data-from]{border-left:3px solid #888;margin:.6em 0;padding-left:.8em}"
    "section[data-from=user]{border-color:#2a6}"
    "section[data-from=assistant]{border-color:#36c}"
    "section[data-from] h3{color:#666;font-size:.85em}"
    "section[data-from] pre{white-space:pre-wrap}"
    "dl.result{display:grid;grid-template-columns:max-content 1fr;gap:.2em 1em}"
    "table.metrics td{padding:.2em 1em .2em 0}"
    "</style></head><body>"
)
REPORT_TAIL = "</body></html>"
EXAMPLE_END = "</article>"
#: Bytes copied at a time when the parts of a report are joined.
COPY_BUFFER = 1 << 20
#: How the parts are packed that ``write_report_files`` joins: markup repeats itself.
PARTS_PACKED = "gzip"
#: How the examples are packed that ``report_lines`` keeps beside the reports.
EXAMPLES_PACKED = "zstd"
#: Whether a query's shuffle files go at its end, not when the driver collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def messages_html(messages, variants: bool = False) -> Column:
    """All messages; with ``variants`` their structs have a field ``variant``."""
    return F.array_join(F.transform(as_col(messages), lambda m: message_html(m["role"], m["content"], m["variant"] if variants else None)), "")


def has_variants(df: DataFrame, messages_col: str = "prompt_messages") -> bool:
    """Whether the messages of a table say which variant of a turn they are."""
    kind = df.schema[messages_col].dataType
    return isinstance(kind, T.ArrayType) and "variant" in kind.elementType.names


def example_html(prompt_messages, response_text, correct_answer, extracted, score, variants: bool = False) -> Column:
    """One example: what was asked, what the model replied, and how it was scored."""

    def entry(name: str, value: Column) -> list[Column]:
        return [F.lit(f"<dt>{name}</dt><dd>"), html_escape(py_str(value)), F.lit("</dd>")]

    return F.concat(
        F.lit("<article><h2>Asked</h2>"),
        messages_html(prompt_messages, variants),
        F.lit("<h2>Replied</h2>"),
        message_html(F.lit("assistant"), response_text),
        F.lit('<dl class="result">'),
        *entry("score", as_col(score).cast("double")),
        *entry("expected", as_col(correct_answer)),
        *entry("found", as_col(extracted)),
        F.lit("</dl>"),
    )


def metrics_table_rows(metrics_long: DataFrame, group_cols: Sequence[str] = ("eval_name", "model_name")) -> DataFrame:
    """One HTML table row per metric (score first, as a rounded headline)."""
    g = list(group_cols)
    is_score = F.col("metric") == "score"
    row = F.when(
        is_score,
        F.concat(F.lit('<tr class="overall"><td>overall score</td><td>'), score_display(F.col("value")).cast("string"), F.lit("</td></tr>")),
    ).otherwise(
        F.concat(F.lit("<tr><td>"), html_escape(F.col("metric")), F.lit("</td><td>"), py_str(F.col("value")), F.lit("</td></tr>"))
    )
    return metrics_long.select(*g, F.when(is_score, 0).otherwise(1).alias("_o"), F.col("metric").alias("_m"), row.alias("line"))


def _order_key(examples: DataFrame, order_col: str) -> Column:
    """Integers padded to sort as text; any other key whole, as it is."""
    whole = isinstance(examples.schema[order_col].dataType, T.IntegralType)
    text = F.col(order_col).cast("string")
    return F.lpad(text, 20, "0") if whole else text


def report_lines(metrics_long: DataFrame, examples: DataFrame, order_col: str = "item_id", group_cols: Sequence[str] = ("eval_name", "model_name")) -> DataFrame:
    """``(group..., section, ord, sub, line)`` lines of one report per group.

    Every group that has metrics or examples gets a whole report; the metrics table
    appears only for groups that have metrics other than the score. Lines never gather
    into one row: sorting by (section, ord, sub) within the group gives the
    file order (see ``write_reports``).
    """
    g = list(group_cols)
    # Both are read several times below and costly to derive: write them once.
    metrics_long = materialize(metrics_long, "report_metrics")
    examples = materialize(examples.select(*g, _order_key(examples, order_col).alias("ord"), "html"), "report_examples", compression=EXAMPLES_PACKED)
    has_table = metrics_long.filter(F.col("metric") != "score").select(*g).distinct()
    groups = metrics_long.select(*g).unionByName(examples.select(*g)).distinct()

    def line(rows: DataFrame, section: int, text, order="", sub="") -> DataFrame:
        as_value = lambda x: x if isinstance(x, Column) else F.lit(x)
        return rows.select(*g, F.lit(section).alias("section"), as_value(order).alias("ord"), as_value(sub).alias("sub"), as_value(text).alias("line"))

    table = metrics_table_rows(metrics_long, g).join(has_table, g, "left_semi")
    parts = [
        line(groups, 0, REPORT_HEAD),
        line(has_table, 1, '<section><h1>Scores</h1><table class="metrics">'),
        line(table, 2, F.col("line"), F.col("_o").cast("string"), F.col("_m")),
        line(has_table, 3, "</table></section>"),
        line(groups, 4, "<section><h1>Answers</h1>"),
        line(examples, 5, F.concat(F.col("html"), F.lit(EXAMPLE_END)), F.col("ord")),
        line(groups, 6, "</section>" + REPORT_TAIL),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_reports(lines: DataFrame, root: str, group_cols: Sequence[str] = ("eval_name", "model_name"), num_partitions: int | None = None, compression: str = "none") -> None:
    """One text folder per (eval, model), lines in report order; a rerun replaces the
    folders of its groups and leaves others alone.

    Range partitioning on the full sort key splits a large group over many
    tasks (a group is never forced into one task); part files then follow the
    ranges, so reading a folder's parts in name order gives the report order. Lines of one
    order come by their text, so a rerun writes the same. ``compression`` is that of Spark's
    text writer. The shuffled lines leave the disk once the parts are written.
    """
    g = list(group_cols)
    order = [*g, "section", "ord", "sub", "line"]
    parts = lines.repartitionByRange(num_partitions, *order) if num_partitions else lines.repartitionByRange(*order)
    with settings(lines.sparkSession, {SHUFFLES_GO: "true"}):
        (
            parts.sortWithinPartitions(*order)
            .select(*g, F.col("line").alias("value"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", compression)
            .partitionBy(*g)
            .text(root)
        )


def write_report_files(lines: DataFrame, root: str, group_cols: Sequence[str] = ("eval_name", "model_name"), num_partitions: int | None = None) -> list[str]:
    """One ``.html`` file per (eval, model) at ``root``, lines in report order; returns their paths.

    All tasks write parts in order (``write_reports``), packed, as they are there to be read
    once. Then each report's parts are unpacked, deleted one by one and joined under a temporary
    name, which is renamed over the old file, so a reader finds the old report or the new one,
    never half of one. Beside the reports, the disk holds one report twice, the packed parts
    that are not joined yet and no shuffled lines. Joining copies bytes through a buffer of fixed size, as
    one file has one writer; whoever can read a folder of parts needs only ``write_reports``.
    """
    spark = lines.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop
    parts_root = f"{root}/_parts/{uuid.uuid4().hex}"
    write_reports(lines, parts_root, group_cols, num_partitions, PARTS_PACKED)
    codecs = hadoop.io.compress.CompressionCodecFactory(conf)
    top = hadoop.fs.Path(parts_root)
    fs = top.getFileSystem(conf)
    files = hadoop.fs.FileContext.getFileContext(top.toUri(), conf)
    replace = spark.sparkContext._gateway.new_array(hadoop.fs.Options.Rename, 1)
    replace[0] = hadoop.fs.Options.Rename.OVERWRITE
    folders: list[list] = [[top]]
    for _ in group_cols:
        folders = [[*f, s.getPath()] for f in folders for s in fs.listStatus(f[-1]) if s.isDirectory()]
    written = []
    for path in folders:
        name = "_".join(p.getName().split("=", 1)[1] for p in path[1:])
        parts = sorted(s.getPath().toString() for s in fs.listStatus(path[-1]) if s.getPath().getName().startswith("part-"))
        temporary = hadoop.fs.Path(f"{parts_root}/{uuid.uuid4().hex}.html")
        out = fs.create(temporary, False)
        try:
            for part in map(hadoop.fs.Path, parts):
                source = codecs.getCodec(part).createInputStream(fs.open(part))
                try:
                    hadoop.io.IOUtils.copyBytes(source, out, COPY_BUFFER, False)
                finally:
                    source.close()
                fs.delete(part, False)
        finally:
            out.close()
        target = hadoop.fs.Path(f"{root}/{name}.html")
        files.rename(temporary, target, replace)
        written.append(target.toString())
    fs.delete(top, True)
    return written


def markdown_lines(pivot: DataFrame, index: str = "model_name") -> DataFrame:
    """Markdown table rows of a pivot: header, rule, then one line per row.

    ``line_no`` orders the lines (0, 1 for the header, then 2.. by index)."""
    cols = pivot.columns
    header = "| " + " | ".join(cols) + " |"
    rule = "|" + "|".join(["---"] * len(cols)) + "|"
    body = pivot.select(
        F.col(index).cast("string").alias("_k"),
        F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]), F.lit(" |")).alias("line"),
    )
    spark = pivot.sparkSession
    head = spark.createDataFrame([(0, "", header), (1, "", rule)], "line_no int, _k string, line string")
    return head.unionByName(body.select(F.lit(2).alias("line_no"), "_k", "line")).withColumnRenamed("_k", "row_key")
