"""Columns of a user's own with the names that the operators use inside stay as they are."""

import warnings

import pytest
from pyspark.sql import functions as F

from gradeflow.llm import langid, minhash, mixing, registry, surrogates

NAMES = ["_row", "row", "rejected", "_found", "_again", "_hash", "_body", "_text_hash", "_doc_id", "_gone", "_id", "_weight", "_probability", "_tokens", "_draw", "_source", "_lang", "_topic", "_topic_all", "_lid_rejected", "text_hash", "kept", "root", "_t", "a.b"]
TEXTS = ["Write to Mr John Smith at john.smith@mail3.example.com or +1 (212) 555-0147 today.", "the same words are said here again and again", "the same words are said here again and again", None, ""]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame([(i if i != 3 else None, t, "en", "src0", len(t or "")) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, lang string, source string, n_chars int")
    return rows.select("*", *[F.concat(F.lit(f"{n}-"), F.coalesce(F.col("doc_id"), F.lit(-1)).cast("string")).alias(n) for n in NAMES])


def check(out, docs):
    assert out.columns == docs.columns
    for r in out.collect():
        assert all(r[n] == f"{n}-{-1 if r['doc_id'] is None else r['doc_id']}" for n in NAMES)
    return out.count()


def test_surrogates(docs):
    out = surrogates.replace_pii(docs, registry.PII_KEY)
    assert check(out, docs) == 5
    assert "john.smith" not in out.filter("doc_id = 0").first()["text"]
    assert surrogates.replace_pii(docs, registry.PII_KEY, count="n").columns == [*docs.columns, "n"]


def test_near_duplicates(docs):
    assert check(minhash.one_of_each(docs), docs) == 4
    twice = docs.unionByName(docs)
    assert check(minhash.one_of_each(twice), docs) in (6, 7, 8)


def test_mixing(docs):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        check(mixing.sample_documents(docs, registry.TARGETS, 0.9), docs)


def test_language(docs):
    check(langid.keep_identified(docs, langid.fit(docs)), docs)


def test_given_names_do_not_give_each_other_away():
    """Names next to each other in the list do not go to names next to each other."""
    made = surrogates._turned(registry.PII_KEY)
    for which, names in surrogates.GIVEN.items():
        to = [names.index(next(n for n in names if n.lower() == made[f"{which}\x1f{n0.lower()}"])) for n0 in names]
        assert sorted(to) == list(range(len(names))) and all(i != j for i, j in enumerate(to))
        steps = {(b - a) % len(names) for a, b in enumerate(to)}
        assert len(steps) > len(names) // 3
        assert made != surrogates._turned("another key")
