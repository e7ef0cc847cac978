"""Approximate nearest neighbours by randomly rotated one-bit codes.

A unit vector x of a cell with centre c has the residual r = x - c, whose direction o is
rotated by one random orthogonal matrix; the signs of its components are its code, one
bit each, and two scalars correct for what the signs lose: the length of r, and the inner
product a of o and its code vector.  For a query q the estimate of <o, q> is the code's
inner product with the rotated query over a, and its error is within

    EPSILON * sqrt((1 - a * a) / (a * a) / (D - 1))

but for a vanishing chance.  A vector is compared exactly (cosine in double precision on
the original vectors) only if its upper bound reaches the k-th best lower bound.

Cells are means of a bounded sample (``SAMPLE`` vectors of least id hash); every row is
indexed.  The number of cells a query visits is the least with a recall of ``RECALL`` for
queries of the sample, so it follows the data.  Cells are dealt out in blocks of at most
about ``BLOCK`` vectors and ``QUERY_BLOCK`` queries, whatever their size.

Cases: see ``vectors``; a null, zero or not finite vector takes no part, nor does a row
without an id; a repeated row counts once; rows with equal vectors tie and go by id; an
empty table gives an empty result; columns other than ``vec_id`` and the vector are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .vectors import asked, centres, entries, main_length, matrix, nearest, ranked, top, usable

SAMPLE = 20_000
MAX_CELLS = 2048
RECALL = 0.97
EPSILON = 3.0
BLOCK, QUERY_BLOCK = 4096, 1024


@dataclass(frozen=True)
class Index:
    means: np.ndarray
    rotation: np.ndarray
    probes: int


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit(sample: np.ndarray, n_rows: int, k: int, seed: int = 11) -> Index:
    points = unit(sample)
    dim = points.shape[1]
    n = int(min(MAX_CELLS, max(1, len(points) // 40), max(1, round(np.sqrt(n_rows) / 4))))
    means = centres(points, n)
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))[0]
    tried = points[:: max(1, len(points) // 256)]
    cell = nearest(points, means, 1)[:, 0]
    order = nearest(tried, means, len(means))
    place = np.argsort(order, axis=1)
    needed = []
    for q, at in zip(tried, place):
        best = np.argsort(-(points @ q), kind="stable")[: k + 1]
        needed += at[cell[best]].tolist()
    probes = int(np.quantile(needed, RECALL, method="higher")) + 1
    return Index(means, rotation, probes)


def codes(x: np.ndarray, cell: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, residual length, and inner product with the code, of unit vectors."""
    residual = x - index.means[cell]
    length = np.sqrt((residual * residual).sum(axis=1))
    turned = (residual / np.maximum(length, 1e-300)[:, None]) @ index.rotation.T
    agree = np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])
    return np.packbits(turned > 0, axis=1), length, np.where(length > 0, agree, 1.0)


def bounds(q: np.ndarray, mean: np.ndarray, packed: np.ndarray, length: np.ndarray, agree: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the inner products of unit queries with a cell's vectors."""
    dim = q.shape[1]
    signs = np.unpackbits(packed, axis=1, count=dim).astype(np.float32) * 2 - 1
    rotated = (q @ index.rotation.T).astype(np.float32) / np.sqrt(dim)
    estimate = (rotated @ signs.T) / agree
    error = EPSILON * np.sqrt(np.maximum(0, 1 - agree**2) / agree**2 / max(1, dim - 1)) + 1e-6
    middle = (q @ mean)[:, None] + length * estimate
    return middle - length * error, middle + length * error


def search(rows: DataFrame, every: int, k: int, vector: str = "embedding", stages: dict | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id ``every`` divides."""
    rows = usable(rows, F.col(vector), zero=False)
    dim = main_length(rows)
    rows = rows.filter(F.size("v") == dim)
    table = entries(rows, k)
    queries = asked(rows, table, every)
    sample = [r[0] for r in table.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0], "v").limit(SAMPLE).select("v").collect()]
    schema = "q bigint, u bigint, score double"
    if not sample:
        return ranked(rows.sparkSession.createDataFrame([], schema), table, queries, k)
    index = fit(np.array(sample, float), table.count(), k)
    if stages is not None:
        stages["index"] = index

    def indexed(batches):
        for b in batches:
            x = unit(matrix(b["v"], dim))
            cell = nearest(x, index.means, 1)[:, 0]
            packed, length, agree = codes(x, cell, index)
            yield pd.DataFrame({"cell": cell, "u": b["u"], "first": b["ids"].str[0], "v": b["v"], "code": [p.tobytes() for p in packed], "length": length, "agree": agree})

    def probed(batches):
        for b in batches:
            cells = nearest(unit(matrix(b["v"], dim)), index.means, index.probes)
            n = cells.shape[1]
            yield pd.DataFrame({"cell": cells.ravel(), "q": np.repeat(b["u"].to_numpy(), n), "qv": b["v"].repeat(n).to_list()})

    data = stored(table.mapInPandas(indexed, "cell bigint, u bigint, first bigint, v array<double>, code binary, length double, agree double"), "codes")
    visits = stored(table.join(queries.select("u").distinct(), "u").select("u", "v").mapInPandas(probed, "cell bigint, q bigint, qv array<double>"), "visits")
    # blocks of each cell: MAX_CELLS rows at most
    sizes = data.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("n_blocks")).join(visits.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("n_parts")), "cell")
    sizes = F.broadcast(sizes)
    left = data.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("u"), "n_blocks")).withColumn("part", F.explode(F.expr("sequence(0L, n_parts - 1)"))).drop("n_blocks", "n_parts")
    right = visits.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("q"), "n_parts")).withColumn("block", F.explode(F.expr("sequence(0L, n_blocks - 1)"))).drop("n_blocks", "n_parts")

    def compare(d: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        out = {"q": [], "u": [], "score": []}
        if len(d) and len(v):
            d = d.sort_values("u")
            x, q0 = matrix(d["v"], dim), matrix(v["qv"], dim)
            packed = np.stack([np.frombuffer(c, np.uint8) for c in d["code"]])
            low, high = bounds(unit(q0), index.means[int(d["cell"].iloc[0])], packed, d["length"].to_numpy(), d["agree"].to_numpy(), index)
            u, first = d["u"].to_numpy(), d["first"].to_numpy()
            scaled = x / np.abs(x).max(axis=1, keepdims=True)
            norm = np.sqrt((scaled * scaled).sum(axis=1))
            for i, q in enumerate(v["q"]):
                least = np.partition(low[i], len(u) - k - 1)[len(u) - k - 1] if len(u) > k + 1 else -np.inf
                at = np.flatnonzero(high[i] >= least)
                a = q0[i] / np.abs(q0[i]).max()
                score = (scaled[at] * a).sum(axis=1) / (norm[at] * np.sqrt((a * a).sum()))
                best = top(score, first[at], k + 1)
                out["q"] += [q] * len(best)
                out["u"] += u[at[best]].tolist()
                out["score"] += score[best].tolist()
        return pd.DataFrame(out).astype({"q": "int64", "u": "int64", "score": "float64"})

    found = left.groupBy("cell", "block", "part").cogroup(right.groupBy("cell", "block", "part")).applyInPandas(compare, schema)
    return ranked(stored(found, "found"), table, queries, k)
