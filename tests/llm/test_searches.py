"""Vector searches against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from gradeflow.llm import onebit, registry, voronoi
from gradeflow.llm.vectors import top
from oracle_check import duck, rows_of


def vectors(spark):
    rows = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id", "embedding").toPandas().sort_values("vec_id")
    return rows.vec_id.to_numpy(), np.stack(rows.embedding).astype(float)


def brute(ids, x, every, k, score):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = score(x, x[i])
        rest = np.flatnonzero(ids != ids[i])
        out[ids[i]] = [(ids[j], s[j]) for j in rest[np.lexsort((ids[rest], -s[rest]))[:k]]]
    return out


def cosine(x, q):
    return (x * q).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((q * q).sum())


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_and_scores_of_one_bit_codes(spark):
    ids, x = vectors(spark)
    want = brute(ids, x, 50, 5, cosine)
    got = by_query(registry.op3_onebit_neighbours(spark, SF_MID).collect())
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9
    known = {(q, i): s for q in want for i, s in zip(ids, cosine(x, x[np.flatnonzero(ids == q)[0]]))}
    assert all(abs(s - known[q, i]) < 1e-12 for q, v in got.items() for i, s in v)


def test_recall_of_one_bit_codes_at_a_larger_size(spark):
    """2,000 vectors, four times those of the test above."""
    large = SF_MID.replace("sf0.01", "sf0.1")
    rows = spark.read.parquet(f"{large}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.stack(rows.embedding).astype(float)
    want = brute(ids, x, 50, 5, cosine)
    got = by_query(registry.op3_onebit_neighbours(spark, large).collect())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.95


def test_estimates_lie_within_their_bounds():
    rng = np.random.default_rng(8)
    x = onebit.unit(rng.normal(size=(2000, 64)))
    index = onebit.fit(x, len(x), 5)
    packed, length, agree = onebit.codes(x, np.zeros(len(x), int), index)
    q = onebit.unit(rng.normal(size=(20, 64)))
    low, high = onebit.bounds(q, index.means[0], packed, length, agree, index)
    true = q @ x.T
    assert ((low <= true) & (true <= high)).mean() > 0.995


def test_exact_search_against_brute_force_and_sql(spark):
    ids, x = vectors(spark)
    want = brute(ids, np.floor(x * 1024), 100, 10, lambda x, q: x @ q)
    got = registry.op9_voronoi_topk(spark, SF_MID)
    assert by_query(got.collect()) == want
    assert rows_of(got.toPandas()) == rows_of(duck(SF_MID).execute(registry.OP9_SQL).df())


def test_pruning_copies_fewer_vectors_and_loses_none(spark):
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(8, 16)) * 3
    x = (middle[rng.integers(0, 8, 3000)] + 0.02 * rng.normal(size=(3000, 16))) / 10
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    stages = {}
    got = voronoi.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 100, 10, stages=stages)
    assert by_query(got.collect()) == brute(np.arange(3000), np.floor(x * 1024), 100, 10, lambda x, q: x @ q)
    assert stages["copies"].count() < 0.7 * stages["need"].shape[0] * 3000


ROWS = [(0, [1.0, 0.0]), (50, [2.0, 0.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0]), (7, None), (8, [None, 1.0]), (9, [float("nan"), 1.0]), (10, [0.0, 0.0]), (11, [float("inf"), 1.0]), (12, []), (None, [1.0, 1.0]), (13, [1.0, 2.0, 3.0]), (14, [0.0, 1.0]), (15, [1.0, 0.0])]


@pytest.mark.parametrize("search, every", [(onebit.search, 50), (voronoi.search, 50)])
def test_edge_cases(spark, search, every):
    df = spark.createDataFrame(ROWS, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).withColumn("u", F.lit(1))
    got = by_query(search(df, every, 3).collect())
    cos = search is onebit.search
    members = {0: (0, 1, 0), 50: (50, 2, 0), 100: (100, 1, 0), 14: (14, 0, 1), 15: (15, 1, 0)} | ({} if cos else {10: (10, 0, 0)})
    for q in (0, 50, 100):
        s = {i: (v[1] * members[q][1] + v[2] * members[q][2]) for i, v in members.items() if i != q}
        if cos:
            s = {i: v / np.hypot(*members[i][1:]) / np.hypot(*members[q][1:]) for i, v in s.items()}
        want = sorted(s, key=lambda i: (-s[i], i))[:3]
        assert [i for i, _ in got[q]] == want
    assert search(df.limit(0), every, 3).count() == 0


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 1.0]) for i in range(500)] + [(1000 + i, [1.0, float(i)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for search in (onebit.search, voronoi.search):
        got = by_query(search(df, 100, 4).collect())
        if search is onebit.search:
            assert [i for i, _ in got[0]] == [1, 2, 3, 4] and [i for i, _ in got[300]] == [0, 1, 2, 3]
        else:
            assert [i for i, _ in got[0]] == [1049, 1048, 1047, 1046]


def test_large_components_stay_exact():
    q, x = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 3.0], [2.0**40, 0.0], [-(2.0**40), 0.0]])
    assert voronoi.exact_scores(q, x)[0].tolist() == [2**60 + 3, 2**63 - 1, -(2**63)]


def test_top_breaks_ties_by_id():
    assert top(np.array([1, 3, 3, 3, 2]), np.array([0, 9, 7, 8, 1]), 2).tolist() == [2, 3]
