"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted in cells (source, language, topic).  Raking scales the cells in turn
to the target of each value of each margin until all hold, with no cell over its own
tokens: a cell's probability is the product of its three factors, at most 1, and a factor is
chosen so that the value's expected sampled tokens, capped cells included, are its target.
So the expected sample of ``budget`` times all tokens meets the targets themselves, not
only before the cap.  A target over what its value holds is what it holds, and the others of
its margin share the rest; such targets, and margins that together cannot be met, are
reported in a warning.  A document's draw is a keyed hash of its id
and text, so a rerun, a lost executor or another partitioning samples the same rows.

The targets are given by the caller, name by name; values without a target of their own
share the ``OTHER`` cell of their margin.  So the table of cells is bounded by the
targets (at most ``MAX_CELLS``), never by the data, and the fitting is a few steps of
numpy on the driver, while counting and sampling are single passes over the documents.

Cases: a null source or language counts to ``OTHER``; a null or empty text has no tokens
and is drawn with its cell's probability; targets of values that do not occur are shared
out among the others of the margin; ``OTHER`` gets what the targets leave (nothing left:
weight 0, its tokens are reported in a warning, and where the rest cannot reach the budget
it is an error); with an empty table nothing is sampled; repeated rows are drawn alike; other
columns pass through.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

OTHER = "other"
MAX_CELLS = 100_000
MARGINS = ("source", "lang", "topic")


def topic(text: Column) -> Column:
    """A text's form as its topic, by the first rule that holds."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(F.contains(t, F.lit(" | ")), "table")
        .when(F.contains(t, F.lit("!! ")), "shout")
        .when(F.contains(t, F.lit("icense")), "licence")
        .when(F.length(t) < 600, "short")
        .otherwise("prose")
    )


def n_tokens(text: Column) -> Column:
    """Words parted by white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


@dataclass(frozen=True)
class Mixture:
    """Weights and probabilities of the cells."""

    cells: list[tuple[str, str, str]]
    tokens: np.ndarray
    weights: np.ndarray
    probabilities: np.ndarray


def rake(totals: np.ndarray, margins: list[tuple[np.ndarray, np.ndarray]], steps: int = 5000, tolerance: float = 1e-9) -> tuple[np.ndarray, float]:
    """(the product of each cell's factors, the largest miss as a share of all targets).

    ``margins``: (value of each cell, target total of each value).  What a cell gives is its
    total times its product, at most the total."""
    goal = max(float(want.sum()) for _, want in margins) or 1.0
    factors = [np.ones(len(want)) for _, want in margins]
    product, worst = np.ones(len(totals)), np.inf
    for _ in range(steps):
        worst = 0.0
        for k, (of_cell, want) in enumerate(margins):
            have = np.bincount(of_cell, weights=totals * np.minimum(1.0, product), minlength=len(want))
            worst = max(worst, float(np.abs(want - have).max(initial=0.0)) / goal)
            others = np.prod([f[v] for j, (f, (v, _)) in enumerate(zip(factors, margins)) if j != k], axis=0) * np.ones(len(totals))
            for value in range(len(want)):
                cells = of_cell == value
                factors[k][value] = multiplier(totals[cells], others[cells], want[value])
            product = others * factors[k][of_cell]
        if worst < tolerance:
            break
    return product, worst


def multiplier(tokens: np.ndarray, weights: np.ndarray, wanted: float) -> float:
    """``c`` for which min(1, c * weight) of the tokens are ``wanted`` in all; where there are
    not so many, one that takes all with a weight."""
    some = (weights > 0) & (tokens > 0)
    tokens, weights = tokens[some], weights[some]
    if wanted <= 0 or not len(tokens):
        return 0.0 if wanted <= 0 else 1.0
    if wanted >= tokens.sum():
        return float(1 / weights.min())
    # between two cells' limits the expected tokens are linear in c
    order = np.argsort(-weights, kind="stable")
    tokens, weights = tokens[order], weights[order]
    full = np.cumsum(tokens) - tokens
    rest = np.cumsum((tokens * weights)[::-1])[::-1]
    c = (wanted - full) / rest
    return float(c[np.flatnonzero(c * weights <= 1 + 1e-12)[0]])


def within_reach(have: np.ndarray, share: np.ndarray, total: float) -> np.ndarray:
    """Targets of ``total`` by the shares, none over what there is; the others share the rest."""
    want, open_ = np.zeros(len(have)), share > 0
    while open_.any():
        left = total - want[~open_].sum()
        want[open_] = share[open_] / share[open_].sum() * left
        over = open_ & (want > have)
        if not over.any():
            break
        want[over] = have[over]
        open_ &= ~over
    return want


def marked(docs: DataFrame, targets: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """The documents with ``_source``, ``_lang``, ``_topic`` (margins) and ``_tokens``."""
    text = F.col("text").cast("string")
    out = docs.withColumn("_tokens", n_tokens(text)).withColumn("_topic_all", topic(text))
    for m in MARGINS:
        c = F.col("_topic_all") if m == "topic" else F.col(m).cast("string")
        out = out.withColumn(f"_{m}", F.when(c.isin(list(targets[m])), c).otherwise(F.lit(OTHER)))
    return out.drop("_topic_all")


def mixture(cells: DataFrame, targets: Mapping[str, Mapping[str, float]], budget: float) -> Mixture:
    """Fit the cells ``(_source, _lang, _topic, tokens)``."""
    bound = int(np.prod([len(targets[m]) + 1 for m in MARGINS]))
    if bound > MAX_CELLS:
        raise ValueError(f"the targets make {bound} cells, over {MAX_CELLS}")
    rows = sorted(tuple(r) for r in cells.select("_source", "_lang", "_topic", "tokens").collect())
    names = [r[:3] for r in rows]
    tokens = np.array([float(r[3] or 0) for r in rows])
    shares, of_cell = [], []
    for k, m in enumerate(MARGINS):
        values = sorted({n[k] for n in names})
        given = {v: float(targets[m].get(v, 0.0)) for v in values if v != OTHER}
        given[OTHER] = max(0.0, 1.0 - sum(targets[m].values()))
        of_cell.append(np.array([values.index(n[k]) for n in names], int))
        shares.append((values, np.array([given[v] for v in values])))
    total = tokens.sum()
    if not total:  # empty texts only
        return Mixture(names, tokens, np.ones(len(tokens)), np.full(len(tokens), min(1.0, budget)))
    aimed = np.all([share[v] > 0 for (_, share), v in zip(shares, of_cell)], axis=0)
    reachable = tokens[aimed].sum()
    if reachable < total:
        left_out = f"{total - reachable:.0f} of {total:.0f} tokens have a source, language or topic with no target share"
        if reachable < min(budget, 1.0) * total:
            raise ValueError(f"{left_out}; the rest cannot reach the budget of {budget:g} of all tokens")
        warnings.warn(f"{left_out} and are never sampled", stacklevel=2)
    goal = min(budget * total, reachable)
    wanted, missed = [], []
    for (values, share), v, m in zip(shares, of_cell, MARGINS):
        have = np.bincount(v, weights=tokens * aimed, minlength=len(values))
        want = within_reach(have, share, goal)
        missed += [f"{m} {x} {w / goal:.4f} of {s:.4f}" for x, s, w, h in zip(values, share / (share.sum() or 1.0), want, have) if w < s * goal * (1 - 1e-9) and w >= h]
        wanted.append((v, want))
    if missed:
        warnings.warn(f"targets over all that there is, taken whole: {', '.join(missed)}", stacklevel=2)
    product, miss = rake(np.where(aimed, tokens, 0.0), wanted)
    if miss > 1e-6:
        warnings.warn(f"the margins cannot be met together: {miss:.2g} of the sample is amiss", stacklevel=2)
    product = np.where(aimed, product, 0.0)
    return Mixture(names, tokens, product * total / goal, np.minimum(1.0, product))


def sampled(rows: DataFrame, fitted: Mixture, seed: str = "mix") -> DataFrame:
    """The marked rows that are drawn, with ``weight`` and ``probability``; rows need
    ``_draw`` from :func:`draw`.  The cell table is bounded by ``MAX_CELLS``."""
    spark = rows.sparkSession
    table = [(*n, float(w), float(p)) for n, w, p in zip(fitted.cells, fitted.weights, fitted.probabilities)]
    cells = spark.createDataFrame(table, "_source string, _lang string, _topic string, _weight double, _probability double")
    return rows.join(F.broadcast(cells), ["_source", "_lang", "_topic"]).filter(F.col("_draw") < F.col("_probability"))


def draw(seed: str, doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) from a keyed hash of a document."""
    h = F.sha2(F.concat_ws("\x1f", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.xxhash64(text).cast("string")), 256)
    return F.conv(F.substr(h, F.lit(1), F.lit(13)), 16, 10).cast("bigint") / F.lit(float(16**13))


def cell_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("tokens"))


def sample_table(docs: DataFrame, targets, budget: float, seed: str = "mix") -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, weight, probability) of the sampled documents;
    source, language and topic as the margins count them."""
    rows = marked(docs.select("doc_id", "text", "source", "lang"), targets).withColumn("_draw", draw(seed, F.col("doc_id"), F.col("text").cast("string")))
    rows = stored(rows.select("doc_id", "_source", "_lang", "_topic", "_tokens", "_draw"), "marked")
    out = sampled(rows, mixture(cell_totals(rows), targets, budget))
    return out.select("doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"), F.col("_weight").alias("weight"), F.col("_probability").alias("probability"))


def sample_documents(docs: DataFrame, targets, budget: float, seed: str = "mix") -> DataFrame:
    """The sampled documents with their own columns, whatever their names."""
    rows = marked(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text", "source", "lang"), targets)
    fitted = mixture(cell_totals(rows), targets, budget)
    rows = rows.withColumn("_draw", draw(seed, F.col("doc_id"), F.col("text").cast("string")))
    return sampled(rows, fitted).select("_row.*")
