"""Per-metric statistics (mean/std/min/max), stat overrides, leaderboard pivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import DEFAULT_STATS, KNOWN_STATS

_STAT_FUNCS = {
    "mean": F.avg,
    "std": F.stddev_pop,  # numpy std: population, 0.0 for one value
    "min": F.min,
    "max": F.max,
}


def _check_stats(stats: Sequence[str]) -> None:
    for s in stats:
        if s not in KNOWN_STATS:
            raise ValueError(f"Unknown stat = {s!r}")


def metric_values(df: DataFrame, group_cols: Sequence[str], metrics_col: str = "metrics", score_col: str | None = "score") -> DataFrame:
    """Long form ``(group..., metric, value)``: every metric-map entry plus the
    row score under the name ``score`` when it is not null."""
    entries = F.map_entries(F.col(metrics_col))
    if score_col is not None:
        score_entry = F.array(F.struct(F.lit("score").alias("key"), F.col(score_col).cast("double").alias("value")))
        entries = F.concat(entries, F.filter(score_entry, lambda e: e["value"].isNotNull()))
    return df.select(*group_cols, F.inline(entries)).withColumnRenamed("key", "metric")


def aggregate_results(
    df: DataFrame,
    group_cols: Sequence[str] = (),
    metrics_col: str = "metrics",
    score_col: str | None = "score",
    default_stats: Sequence[str] = DEFAULT_STATS,
    name2stats: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Statistics per (group..., metric) in long form ``(group..., metric, value)``.

    The metric key is the name for ``mean`` and ``name:stat`` otherwise, so the
    ``score`` row is the headline score.  One hash aggregation with map-side
    partial combine; a hot group (one model or one metric holding most rows)
    only grows the partial buffers, never one task's input.
    """
    name2stats = dict(name2stats or {})
    _check_stats(default_stats)
    for stats in name2stats.values():
        _check_stats(stats)
    wanted = sorted(set(default_stats).union(*[set(v) for v in name2stats.values()]) if name2stats else set(default_stats))
    group_cols = list(group_cols)
    long = metric_values(df, group_cols, metrics_col, score_col)
    stats = long.groupBy(*group_cols, "metric").agg(
        *[_STAT_FUNCS[s](F.col("value")).alias(f"_s_{s}") for s in wanted]
    )
    return select_stats(stats, group_cols, wanted, default_stats, name2stats)


def _stats_for(metric: Column, default_stats: Sequence[str], name2stats: Mapping[str, Sequence[str]]) -> Column:
    default = F.array(*[F.lit(s) for s in default_stats])
    expr = None
    for name, stats in name2stats.items():
        arr = F.array(*[F.lit(s) for s in stats]) if stats else F.array().cast("array<string>")
        expr = F.when(metric == name, arr) if expr is None else expr.when(metric == name, arr)
    return default if expr is None else expr.otherwise(default)


def select_stats(stats: DataFrame, group_cols, wanted, default_stats, name2stats) -> DataFrame:
    """Keep, per metric, the stats it asks for, and name them the toolkit's way."""
    pairs = F.array(*[F.struct(F.lit(s).alias("stat"), F.col(f"_s_{s}").cast("double").alias("value")) for s in wanted])
    chosen = _stats_for(F.col("metric"), default_stats, name2stats)
    picked = stats.select(
        *group_cols, "metric", F.inline(F.filter(pairs, lambda p: F.array_contains(chosen, p["stat"])))
    )
    key = F.when(F.col("stat") == "mean", F.col("metric")).otherwise(F.concat(F.col("metric"), F.lit(":"), F.col("stat")))
    return picked.select(*group_cols, key.alias("metric"), "value")


def headline(metrics_long: DataFrame, group_cols: Sequence[str] = ("eval_name", "model_name")) -> DataFrame:
    """``f1_score`` if present, else ``score`` per (eval, model)."""
    g = list(group_cols)
    m = metrics_long.filter(F.col("metric").isin("f1_score", "score"))
    value = F.coalesce(
        F.max(F.when(F.col("metric") == "f1_score", F.col("value"))),
        F.max(F.when(F.col("metric") == "score", F.col("value"))),
    )
    # A pivot cell must have one source row: duplicates fail the query in-plan.
    dup = (F.count_if(F.col("metric") == "score") > 1) | (F.count_if(F.col("metric") == "f1_score") > 1)
    message = F.concat(F.lit("duplicate headline entries for "), F.concat_ws("/", *[F.col(c).cast("string") for c in g]))
    return m.groupBy(*g).agg(F.when(dup, F.raise_error(message).cast("double")).otherwise(value).alias("metric"))


def leaderboard(metrics_long: DataFrame, eval_names: Sequence[str], index: str = "model_name", column: str = "eval_name") -> DataFrame:
    """Model x eval pivot of the headline metric; pivot values are given, so no extra job."""
    head = headline(metrics_long, (column, index))
    return head.groupBy(index).pivot(column, list(eval_names)).agg(F.first("metric"))
