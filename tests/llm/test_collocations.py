"""Phrase collocations against plain counting, and passes after a poor sample."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import SF_MID, SF_SMALL

from gradeflow.llm import collocations


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
        yield [w for w in re.split(r"[\x20\x09]+", piece) if w]


def counts(docs, longest=4):
    f = Counter()
    for text, lang in docs:
        for ws in pieces(text):
            f.update((lang or "und", " ".join(ws[i : i + k])) for k in range(1, longest + 1) for i in range(len(ws) - k + 1))
    return f


def plain(docs, least, top=2000, covered=80):
    f = counts(docs)
    n = Counter()
    for (lang, p), c in f.items():
        if " " not in p:
            n[lang] += c
    found, longer = [], Counter()
    for (lang, p), a in f.items():
        ws = p.split(" ")
        if a < least:
            continue
        for k in range(2, len(ws)):
            for i in range(len(ws) - k + 1):
                key = lang, " ".join(ws[i : i + k])
                longer[key] = max(longer[key], a)
        if len(ws) > 1:
            cuts = []
            for k in range(1, len(ws)):
                left, right = f[lang, " ".join(ws[:k])], f[lang, " ".join(ws[k:])]
                cuts.append((2000000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((lang, p, a, left, right, n[lang], score))
    found = [x for x in found if 100 * longer[x[0], x[1]] < covered * x[2]]
    out = []
    for lang in n:
        mine = sorted((x for x in found if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        out += [(lang, i, *x[1:]) for i, x in enumerate(mine, 1)]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_table_against_plain_counting(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    local = [(r["text"], r["lang"]) for r in docs.collect()]
    assert rows(collocations.collocations(docs, least=5, top=300)) == plain(local, 5, 300)


def test_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = sorted(con.sql(collocations.SQL).select("lang, rank, phrase, a, l, r, n, score").fetchall())
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert rows(collocations.collocations(docs)) == want == plain([(r["text"], r["lang"]) for r in docs.collect()], 30)


@pytest.mark.parametrize("sample", [1, 1 << 30])
def test_any_sample_gives_the_same(spark, sample, monkeypatch):
    """A sample of all and one of nothing: only the number of passes differs."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    passes = []
    real = collocations.counted
    monkeypatch.setattr(collocations, "counted", lambda *a, **k: passes.append(k) or real(*a, **k))
    got, totals = collocations.frequent(docs, 10, 4, sample)
    f = counts([(r["text"], r["lang"]) for r in docs.collect()])
    assert sorted((r["lang"], r["phrase"], r["f"]) for r in got.collect()) == sorted((*k, c) for k, c in f.items() if c >= 10)
    assert sum(r["n"] for r in totals.collect()) == sum(c for (_, p), c in f.items() if " " not in p)
    full = [k for k in passes if not k]
    assert len(full) == (1 if sample == 1 else 4)


def test_edges(spark):
    texts = [("A b. a B\ta b", "en"), ("a b", None), ("a b", "und"), (None, "en"), ("", None), ("...", "x"), ("é É  é", "fr"), ("a b " * 5000, "long"), ("a\x0bb\x1cc d", "en")]
    texts = texts + texts  # repeated rows
    df = spark.createDataFrame([(i % 3, t, v, 1, 2, "z") for i, (t, v) in enumerate(texts)], "doc_id int, text string, lang string, n int, f int, phrase string")
    assert rows(collocations.collocations(df, least=2)) == plain(texts, 2)
    assert rows(collocations.collocations(df.limit(0))) == []
    assert rows(collocations.collocations(df, least=10**9)) == []


def test_blocks_and_slices(spark, monkeypatch):
    """Blocks of a few words, slices of a few bytes and small tables count the same."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    local = [(r["text"], r["lang"]) for r in docs.collect()]
    want = sorted((*k, c) for k, c in counts(local).items() if c >= 4)
    for name, value in (("FLUSH", 50), ("KEPT_WORDS", 10), ("SLICE", 7), ("HELD_HASHES", 100), ("HELD_PHRASES", 10), ("ROWS_OUT", 3), ("MERGED", 2)):
        monkeypatch.setattr(collocations, name, value)
    found, _ = collocations.frequent(docs, 4)
    assert sorted((r["lang"], r["phrase"], r["f"]) for r in found.collect()) == want


def test_hashes_that_meet(spark, monkeypatch):
    """Hashes of few values: many phrases share one, and the counts are still exact."""
    real = collocations._mix
    monkeypatch.setattr(collocations, "_mix", lambda h: real(h) & np.uint64(0xFF00000000000000))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(30)
    want = sorted((*k, c) for k, c in counts([(r["text"], r["lang"]) for r in docs.collect()]).items() if c >= 5)
    found, _ = collocations.frequent(docs, 5)
    assert sorted((r["lang"], r["phrase"], r["f"]) for r in found.collect()) == want


def test_ties_and_exact_arithmetic(spark):
    df = spark.createDataFrame([("x y. z w. p q r s", "en")] * 40, "text string, lang string").withColumn("doc_id", __import__("pyspark").sql.functions.lit(1))
    got = rows(collocations.collocations(df, least=30))
    assert got == plain([("x y. z w. p q r s", "en")] * 40, 30)
    assert [r[2] for r in got] == ["p q r s", "x y", "z w"]
