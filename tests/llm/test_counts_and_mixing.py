"""Token counts and mixing against brute force."""

import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from gradeflow.llm import mixing, registry, tokencounts


def lengths(spark):
    with open(registry.BYTE_PAIR_RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return np.array([len(enc.encode_ordinary(r.text)) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()])


def test_every_answer_of_the_histogram(spark):
    n = lengths(spark)
    got = registry.op4_token_counts(spark, SF_SMALL)
    rows = {r.n_tokens: r for r in got.collect()}
    assert sorted(rows) == sorted(set(n.tolist()))
    for v, r in rows.items():
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == ((n == v).sum(), (n >= v).sum(), n[n >= v].sum())
        assert r.tokens_cut_here == np.minimum(n, v).sum() and abs(r.quantile - (n <= v).mean()) < 1e-12
    got = got.cache()
    for limit in (0, 1, 100, 333, 2048, 10**7):
        r = tokencounts.at_limit(got, limit).first()
        assert (r.docs_over, r.tokens_cut) == ((n > limit).sum(), np.minimum(n, limit).sum())


def test_count_edge_cases(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (2, "a b"), (2, "a b"), (3, "x" * 20_000)], "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    out = tokencounts.token_lengths(docs, registry.BYTE_PAIR_RANKS, public_tokenizers.PATTERN)
    rows = [(r.doc_id, r.n_tokens) for r in out.collect()]
    assert rows[:4] == [(1, 0), (None, 0), (2, 2), (2, 2)] and rows[4][1] > 1
    assert tokencounts.totals(tokencounts.histogram(out.limit(0))).count() == 0


def cells_and_margins(seed, n=60):
    rng = np.random.default_rng(seed)
    totals = rng.uniform(1, 100, n)
    cells = [(i % 5, i // 5 % 4, i // 20) for i in range(n)]
    return totals, [(np.array([c[k] for c in cells]), rng.dirichlet(np.ones(m) * 8)) for k, m in ((0, 5), (1, 4), (2, 3))]


@pytest.mark.parametrize("part", [0.05, 0.3, 0.6])
def test_raking_meets_every_margin_under_the_cap(part):
    """Whatever is capped, the expected tokens of every value are its target."""
    totals, margins = cells_and_margins(3)
    goal = part * totals.sum()
    wanted = [(v, mixing.within_reach(np.bincount(v, weights=totals), share, goal)) for v, share in margins]
    product, miss = mixing.rake(totals, wanted)
    p = np.minimum(1, product)
    assert miss < 1e-8
    for (v, want), (_, share) in zip(wanted, margins):
        assert np.allclose(np.bincount(v, weights=totals * p), want, rtol=1e-6) and np.allclose(want, share * goal)
    if part == 0.6:
        assert (product > 1).sum() > 3
    # uncapped cells: a product of one factor per margin
    free = product < 1
    design = np.concatenate([np.eye(v.max() + 1)[v] for v, _ in margins], axis=1)[free]
    logs = np.log(product[free])
    assert np.abs(design @ np.linalg.lstsq(design, logs, rcond=None)[0] - logs).max() < 1e-8


def test_targets_out_of_reach_are_taken_whole_and_reported(spark):
    want = mixing.within_reach(np.array([5.0, 50.0, 100.0, 0.0]), np.array([0.3, 0.3, 0.3, 0.1]), 90.0)
    assert want.tolist() == [5.0, 42.5, 42.5, 0.0]
    docs = spark.createDataFrame([(i, "a b c", "en", "few" if i < 10 else "many") for i in range(100)], "doc_id long, text string, lang string, source string")
    with pytest.warns(UserWarning, match="source few"):
        got = mixing.sample_table(docs, {"source": {"few": 0.5, "many": 0.5}, "lang": {}, "topic": {}}, 0.5).collect()
    assert {r.probability for r in got if r.source == "few"} == {1.0}
    assert abs({r.probability for r in got if r.source == "many"}.pop() - 40 / 90) < 1e-6
    crossed = spark.createDataFrame([(i, "a b c", "en" if i < 50 else "fr", "x" if i < 50 else "y") for i in range(100)], "doc_id long, text string, lang string, source string")
    with pytest.warns(UserWarning, match="met together"):
        mixing.sample_table(crossed, {"source": {"x": 0.9, "y": 0.1}, "lang": {"en": 0.1, "fr": 0.9}, "topic": {}}, 0.5).collect()


def plain_probabilities(rows):
    """Cells, and raking by loops with each factor found by bisection; doc_id -> probability."""
    import re

    def cell(r):
        t = r.text or ""
        form = "table" if " | " in t else "shout" if "!! " in t else "licence" if "icense" in t else "short" if len(t) < 600 else "prose"
        return tuple(v if v in registry.TARGETS[m] else "other" for m, v in zip(mixing.MARGINS, (r.source, r.lang, form)))

    tokens = {}
    for r in rows:
        tokens[cell(r)] = tokens.get(cell(r), 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    goal = registry.BUDGET * sum(tokens.values())
    targets = {}
    for k, m in enumerate(mixing.MARGINS):
        given = dict(registry.TARGETS[m]) | {"other": max(0.0, 1 - sum(registry.TARGETS[m].values()))}
        have = {v: sum(t for c, t in tokens.items() if c[k] == v) for v in {c[k] for c in tokens}}
        whole = {}
        while True:  # what is over all that there is, is all that there is
            rest = [v for v in have if v not in whole]
            aim = {v: given[v] / sum(given[x] for x in rest) * (goal - sum(whole.values())) for v in rest}
            if not (over := {v: have[v] for v in rest if aim[v] > have[v]}):
                break
            whole |= over
        targets |= {(k, v): x for v, x in (aim | whole).items()}
    factor = {}
    for _ in range(150):
        for k in range(3):
            for v in {c[k] for c in tokens}:
                target = targets[k, v]
                cells = [(tokens[c], np.prod([factor.get((j, c[j]), 1.0) for j in range(3) if j != k])) for c in tokens if c[k] == v]
                lo, hi = 0.0, 1 / min(w for _, w in cells)
                for _ in range(60):
                    mid = (lo + hi) / 2
                    lo, hi = (mid, hi) if sum(t * min(1, mid * w) for t, w in cells) < target else (lo, mid)
                factor[k, v] = (lo + hi) / 2
    return {r.doc_id: min(1.0, np.prod([factor[j, x] for j, x in enumerate(cell(r))])) for r in rows}, tokens, cell, targets


def test_query_meets_the_margins_and_a_plain_version(spark):
    """Expected tokens of the sample at sf0.01 are the targets, value by value; one is out of
    reach (all licence texts are 0.0484 of the sample, not 0.06) and is taken whole."""
    rows = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    got = {r.doc_id: r for r in registry.op2_mixing_weights(spark, SF_MID).collect()}
    want, tokens, cell, targets = plain_probabilities(rows)
    draws = {r[0]: r[1] for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", mixing.draw("mix", F.col("doc_id"), F.col("text"))).collect()}
    assert all(abs(r.probability - want[i]) < 1e-4 for i, r in got.items())
    assert set(got) == {i for i, p in want.items() if draws[i] < p}
    of_cell = {cell(r): want[r.doc_id] for r in rows}
    expected = {c: tokens[c] * of_cell[c] for c in tokens}
    whole = sum(expected.values())
    assert abs(whole / sum(tokens.values()) - registry.BUDGET) < 1e-6
    for (k, v), target in targets.items():
        assert abs(sum(x for c, x in expected.items() if c[k] == v) - target) < 1e-6 * whole
    en = sum(x for c, x in expected.items() if c[1] == "en") / whole
    assert abs(en - registry.TARGETS["lang"]["en"] / sum(registry.TARGETS["lang"].values())) < 1e-6  # within reach, so met


def test_draws_are_even_and_mixing_edge_cases(spark):
    draws = [r[0] for r in spark.range(4000).select(mixing.draw("s", F.col("id"), F.lit("t"))).collect()]
    assert abs(np.mean(draws) - 0.5) < 0.02 and 0 <= min(draws) and max(draws) < 1
    rows = [(1, None, None, None), (2, "", "en", "src0"), (2, "", "en", "src0"), (None, "a b c", "xx", "src1"), (4, "word " * 30_000, "fr", "src2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("weight", F.lit("clash"))
    assert mixing.sample_documents(docs, registry.TARGETS, 0.5).columns == docs.columns
    everything = mixing.sample_documents(docs, {"source": {}, "lang": {}, "topic": {}}, 1.0)
    assert everything.count() == 5
    assert mixing.sample_documents(docs.limit(0), registry.TARGETS, 0.5).count() == 0
    assert mixing.sample_table(docs.limit(0), registry.TARGETS, 0.5).count() == 0


def test_documents_without_a_language_are_drawn_and_the_budget_is_met(spark):
    """Four of five rows have no language, so the rest alone cannot reach half of all tokens."""
    rows = [(i, "word " * (50 + i % 300), "en fr de es xx".split()[i // 5 % 5] if i % 5 == 0 else None, f"src{i % 21}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.sample_documents(docs, registry.TARGETS, registry.BUDGET).collect()
    assert any(r.lang is None for r in got) and any(r.lang == "xx" for r in got)
    tokens = sum(len(r.text.split()) for r in got) / sum(len(r[1].split()) for r in rows)
    assert abs(tokens - registry.BUDGET) < 0.05


def test_tokens_without_a_target_share_are_reported(spark):
    docs = spark.createDataFrame([(i, "a b c", "en" if i < 60 else None, "src1") for i in range(100)], "doc_id long, text string, lang string, source string")
    targets = {"source": {}, "lang": {"en": 1.0}, "topic": {}}
    with pytest.raises(ValueError, match="120 of 300 tokens"):
        mixing.sample_documents(docs, targets, 0.7)
    with pytest.warns(UserWarning, match="never sampled"):
        assert mixing.sample_documents(docs, targets, 0.5).filter("lang is null").isEmpty()
