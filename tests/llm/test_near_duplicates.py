"""Min-max hashing against brute force, and the component algorithm."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import SF_SMALL
from gradeflow.llm import minhash, registry
from gradeflow.llm.components import components
from gradeflow.llm.shingles import shingle_sets


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_components(rows):
    """doc_id -> smallest id reachable, over all pairs."""
    sets = [(i, plain_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (a, s) in enumerate(sets):
        for b, t in sets[n + 1 :]:
            both = len(s & t)
            if both and 100 * both >= 75 * (len(s) + len(t) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def family(n, seed=3, words=150, edits=4, start=1000):
    """Copies of one text with a few words replaced: many pairs lie around the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
        out.append((start + i, " ".join(copy)))
    return out


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert got == plain_components(rows)


def test_sets_equal_plain_sets():
    texts = ["A b c d E f", "a B C D e F", "one two", "Two one", "", None, " \n\t", "É b c d e", "é b c d e", "x " * 10]
    sets = shingle_sets(pa.array(texts))
    for a, s in zip(texts, sets):
        assert len(s) == len(plain_set(a))
        for b, t in zip(texts, sets):
            assert (plain_set(a) == plain_set(b)) == np.array_equal(s, t)


def test_signature_agreement_estimates_the_similarity():
    rng = np.random.default_rng(5)
    common, a, b = (rng.integers(0, 1 << 63, n, np.uint64) for n in (3000, 500, 500))
    x, y = minhash.signature(np.concatenate([common, a])), minhash.signature(np.concatenate([common, b]))
    assert abs((x == y).mean() - 0.75) < 0.12


def test_family_around_the_threshold(spark):
    check(spark, family(120) + family(40, seed=9, words=30, edits=3, start=5000))


def test_small_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in registry.op8_minhash_near_dedup(spark, SF_SMALL).collect()}
    assert {i: v[:2] for i, v in got.items()} == plain_components(rows)
    assert all(kept == (i == c) for i, (_, c, kept) in got.items())


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (5, "one two"), (None, "one two"), (None, "alone here"), (8, "w " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("clash"))
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in minhash.near_duplicates(docs).collect()))
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False), (0, 1, 4, False), (0, 1, 0, True), (8, 1, 8, True)])
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "a b c"), (1, "a b c"), (2, "A b c"), (3, "other"), (3, "third text"), (3, "a B c"), (4, ""), (4, ""), (5, None), (6, long), (6, long + " end"), (7, long + " fin")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    got = sorted((r.doc_id, r.text or "") for r in minhash.one_of_each(docs).collect())
    assert [r for r in got if r[0] != 6] == [(1, "a b c"), (3, "other"), (3, "third text"), (4, ""), (4, ""), (5, "")]
    assert len([r for r in got if r[0] == 6]) == 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
