"""Exact top-k search by a Voronoi join.

Queries and data are grouped by the nearest of some pivots.  From small summaries (for
each data cell the distances of its k + 1 nearest members to the pivot, for each query
group the range of its inner products with every pivot and its largest norm) bounds are
derived for a whole query group:

    q.x >= min q.p - |q| * |x - p|   and   q.x <= max q.p + |q| * |x - p|

The (k + 1)-th best lower bound over all cells is what a vector must be able to reach: a
member of a cell is copied to a query group only if its own distance lets the upper bound
reach it.  Each group is then solved locally, in blocks, with exact integer scores.

Pivots are means of a bounded sample (``SAMPLE`` vectors of least id hash); they only
steer the pruning, the result is exact for any pivots.  The number of pivots is bounded
by ``MAX_PIVOTS``, so summaries and bounds are too.

Cases: see ``vectors``; components are floor(1024 * x); a null vector or one with null or
non-finite components takes no part, a zero vector does; scores beyond the range of a
long are set to its end; a repeated row counts once; equal scores go by id; an empty
table gives an empty result; columns other than ``vec_id`` and the vector are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored
from .vectors import asked, centres, entries, main_length, matrix, nearest, ranked, top, usable

SAMPLE = 10_000
MAX_PIVOTS = 256
BLOCK, QUERY_BLOCK = 8192, 512
SCALE = 1024
EXACT = 2.0**53
LONG = 2**63 - 1


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where every partial sum is exact, else in integers."""
    if not len(q) or not len(x):
        return np.zeros((len(q), len(x)), np.int64)
    if np.abs(q).max() * np.abs(x).max() * q.shape[1] < EXACT:
        return (q @ x.T).astype(np.int64)
    big = np.array([[int(c) for c in r] for r in q], object) @ np.array([[int(c) for c in r] for r in x], object).T
    return np.clip(big, -LONG - 1, LONG).astype(np.int64)


def reach(least: dict[int, list[float]], ranges: dict[tuple[int, int], tuple[float, float, float]], n: int, k: int) -> np.ndarray:
    """For each query group and data cell the distance to the pivot from which on a member
    is needed (infinite: none is).  ``least``: the k + 1 smallest distances of each cell;
    ``ranges``: least and largest inner product with the pivot, and norm, of each group."""
    need = np.full((n, n), np.inf)
    for i in {i for i, _ in ranges}:
        norm = max(ranges[i, j][2] for j in range(n))
        lows = np.sort(np.concatenate([ranges[i, j][0] - norm * np.array(least.get(j, []), float) for j in range(n)]))[::-1]
        bar = lows[k] if len(lows) > k else -np.inf
        for j in range(n):
            gap = bar - ranges[i, j][1]
            slack = 1e-9 * (abs(bar) + abs(ranges[i, j][1]) + 1) if np.isfinite(bar) else 0.0
            need[i, j] = -np.inf if gap <= slack else ((gap - slack) / norm) * (1 - 1e-9) if norm > 0 else np.inf
    return need


def search(rows: DataFrame, every: int, k: int, vector: str = "embedding", stages: dict | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each row whose id ``every`` divides."""
    rows = usable(rows, F.col(vector), zero=True)
    rows = rows.select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")).alias("v"))
    dim = main_length(rows)
    rows = rows.filter(F.size("v") == dim)
    table = entries(rows, k)
    queries = asked(rows, table, every)
    sample = [r[0] for r in table.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0], "v").limit(SAMPLE).select("v").collect()]
    schema = "q bigint, u bigint, score bigint"
    if not sample:
        return ranked(rows.sparkSession.createDataFrame([], schema), table, queries, k)
    total = table.count()
    n = int(min(MAX_PIVOTS, len(sample), max(1, round(np.sqrt(total) / 8))))
    pivots = centres(np.array(sample, float), n)
    n = len(pivots)

    def grouped(batches):
        for b in batches:
            x = matrix(b["v"], dim)
            cell = nearest(x, pivots, 1)[:, 0]
            yield pd.DataFrame({"cell": cell, "u": b["u"], "first": b["ids"].str[0], "distance": np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1)), "v": b["v"]})

    def ranges(batches):
        for b in batches:
            q = matrix(b["v"], dim)
            dots, norm = q @ pivots.T, np.sqrt((q * q).sum(axis=1))
            groups = b["cell"].to_numpy()
            for g in np.unique(groups):
                own = groups == g
                yield pd.DataFrame({"g": g, "cell": np.arange(n), "lo": dots[own].min(axis=0), "hi": dots[own].max(axis=0), "norm": norm[own].max(), "n": int(own.sum())})

    data = stored(table.mapInPandas(grouped, "cell bigint, u bigint, first bigint, distance double, v array<double>"), "cells")
    asking = data.join(queries.select("u").distinct(), "u")
    near = data.withColumn("n", F.row_number().over(Window.partitionBy("cell").orderBy("distance", "u"))).filter(F.col("n") <= k + 1)
    # the summaries: at most (k + 1) * MAX_PIVOTS and MAX_PIVOTS ** 2 rows
    least: dict[int, list[float]] = {}
    for cell, distance in near.select("cell", "distance").collect():
        least.setdefault(cell, []).append(distance)
    summary = asking.select("cell", "v").mapInPandas(ranges, "g bigint, cell bigint, lo double, hi double, norm double, n bigint")
    summary = summary.groupBy("g", "cell").agg(F.min("lo"), F.max("hi"), F.max("norm"), F.sum("n")).collect()
    need = reach(least, {(r[0], r[1]): (r[2], r[3], r[4]) for r in summary}, n, k)
    n_parts = {r[0]: -(-r[5] // QUERY_BLOCK) for r in summary}
    n_blocks = max(1, -(-total // BLOCK))

    def copied(batches):
        for b in batches:
            wanted = need[:, b["cell"].to_numpy()] <= b["distance"].to_numpy()
            for g, parts in n_parts.items():
                own = b[wanted[g]]
                for part in range(parts if len(own) else 0):
                    yield pd.DataFrame({"g": g, "part": part, "u": own["u"], "first": own["first"], "v": own["v"]})

    left = data.select("cell", "u", "first", "distance", "v").mapInPandas(copied, "g bigint, part bigint, u bigint, first bigint, v array<double>").withColumn("block", F.pmod(F.xxhash64("u"), F.lit(n_blocks)))
    if stages is not None:
        stages["need"], stages["copies"] = need, left
    parts = F.coalesce(*[F.when(F.col("cell") == g, F.lit(p)) for g, p in n_parts.items()], F.lit(1)) if n_parts else F.lit(1)
    right = asking.select(F.col("cell").alias("g"), F.pmod(F.xxhash64("u"), parts).alias("part"), F.col("u").alias("q"), F.col("v").alias("qv")).withColumn("block", F.explode(F.expr(f"sequence(0L, {n_blocks - 1}L)")))

    def solve(d: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        out = {"q": [], "u": [], "score": []}
        if len(d) and len(a):
            u, first = d["u"].to_numpy(), d["first"].to_numpy()
            scores = exact_scores(matrix(a["qv"], dim), matrix(d["v"], dim))
            for q, row in zip(a["q"], scores):
                best = top(row, first, k + 1)
                out["q"] += [q] * len(best)
                out["u"] += u[best].tolist()
                out["score"] += row[best].tolist()
        return pd.DataFrame(out).astype("int64")

    found = left.groupBy("g", "block", "part").cogroup(right.groupBy("g", "block", "part")).applyInPandas(solve, schema)
    return ranked(stored(found, "found"), table, queries, k)
