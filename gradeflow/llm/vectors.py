"""Vector tables of the two searches: distinct vectors with their smallest ids, queries,
and the ranking of what was found.

Rows with equal vectors are one entry, which keeps its ``k + 1`` smallest ids: a query
takes at most ``k`` of them, and one may be its own, so no other id can be in a result.
A vector that a third of all rows share so costs one entry, found with a limit per group
before the shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored


def usable(rows: DataFrame, vector: Column, zero: bool) -> DataFrame:
    """(vec_id, v): rows with an id and a vector of finite components; with ``zero`` false
    not all of them 0.  Vectors of another length than the most frequent take no part."""
    out = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.cast("array<double>").alias("v")).filter("vec_id is not null and v is not null and size(v) > 0")
    out = out.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    if not zero:
        out = out.filter(F.exists("v", lambda x: x != 0))
    return out


def main_length(rows: DataFrame) -> int:
    """The most frequent number of components; 0 for an empty table."""
    first = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return first[0] if first else 0


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(u, v, ids): the distinct vectors, written once, with their k + 1 smallest ids."""
    order = Window.partitionBy("v").orderBy("vec_id")
    least = rows.withColumn("n", F.dense_rank().over(order)).filter(F.col("n") <= k + 1)
    groups = least.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    return stored(groups.select(F.monotonically_increasing_id().alias("u"), "v", "ids"), "entries")


def asked(rows: DataFrame, vectors: DataFrame, every: int) -> DataFrame:
    """(query_id, u): the queries, every row whose id ``every`` divides."""
    queries = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v").distinct()
    return stored(queries.join(vectors.select("u", "v"), "v").select("query_id", "u"), "asked")


def ranked(found: DataFrame, vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) from the found pairs of entries ``(q, u, score)``."""
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.col("vec_id"))
    ids = found.join(vectors.select("u", "ids"), "u").select("q", "score", F.explode("ids").alias("vec_id"))
    few = ids.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n")
    rows = queries.withColumnRenamed("u", "q").join(few, "q").filter("vec_id <> query_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id"))
    return rows.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def centres(points: np.ndarray, n: int, seed: int = 3, steps: int = 8) -> np.ndarray:
    """``n`` means of a bounded sample by Lloyd's steps, an empty cell keeping its mean."""
    rng = np.random.default_rng(seed)
    means = points[np.sort(rng.choice(len(points), min(n, len(points)), replace=False))].astype(float)
    for _ in range(steps):
        cell = nearest(points, means, 1)[:, 0]
        size = np.bincount(cell, minlength=len(means))
        total = np.zeros_like(means)
        np.add.at(total, cell, points)
        means = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], means)
    return means


def nearest(points: np.ndarray, means: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest means of each point, nearest first, in bounded blocks."""
    out = np.empty((len(points), min(n, len(means))), np.int64)
    half = (means * means).sum(axis=1) / 2
    for at in range(0, len(points), 4096):
        out[at : at + 4096] = np.argsort(half - points[at : at + 4096] @ means.T, axis=1, kind="stable")[:, :n]
    return out


def matrix(series, dim: int) -> np.ndarray:
    """Rows of a column of arrays."""
    return np.stack(series.to_numpy()).astype(float) if len(series) else np.zeros((0, dim))


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        place = np.flatnonzero(scores >= least)
    else:
        place = np.arange(len(scores))
    return place[np.lexsort((ids[place], -scores[place]))[:k]]
