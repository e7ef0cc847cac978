"""The pipeline's stages, one after the other, against plain versions."""

import hashlib
import inspect

import corpus_pipeline
from conftest import SF_SMALL
from gradeflow.llm import langid, registry
from gradeflow.llm.common import DOCUMENT_COLUMNS
from gradeflow.llm.sentencepieces import Pieces
from test_counts_and_mixing import plain_probabilities
from test_near_duplicates import plain_components


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_and_run(spark):
    import __spark_entry__ as entry
    from gradeflow.llm import mixing
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL).cache()
        kept[name] = (docs, out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns == DOCUMENT_COLUMNS
        docs = out
    before, after = kept["language_id"]
    rejected = {r.doc_id for r in langid.identify(before, langid.fit(before)).collect() if r.rejected}
    assert set(rows_of(after)) == set(rows_of(before)) - rejected
    before, after = kept["minhash_near_dedup"]
    classes = plain_components([(r.doc_id, r.text) for r in before.collect()])
    assert set(rows_of(after)) == {i for i, (_, c) in classes.items() if i == c}
    before, after = kept["pii_surrogates"]
    old, new = rows_of(before), rows_of(after)
    assert set(old) == set(new) and all(r.n_chars == len(r.text) for r in new.values())
    assert any(old[i].text != new[i].text for i in old) and all(old[i][2:4] == new[i][2:4] for i in old)
    before, after = kept["mixing_weights"]
    draws = {r[0]: r[1] for r in before.select("doc_id", mixing.draw("mix", F.col("doc_id"), F.col("text"))).collect()}
    assert set(rows_of(after)) == {i for i, p in plain_probabilities(before.collect())[0].items() if draws[i] < p}
    before, after = kept["sentencepiece"]
    with open(registry.SENTENCEPIECE_MODEL, "rb") as f:
        library = Pieces(f.read()).library
    texts = rows_of(before)
    for i, r in rows_of(after).items():
        ids = library.encode(texts[i].text, add_eos=True)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert rows_of(entry.queries()["pipeline"](spark, SF_SMALL)) == rows_of(after)
    assert list(inspect.signature(corpus_pipeline.run).parameters) == ["spark", "sf_dir"]


def through(spark, docs, folder):
    """The documents of each stage, each written and read again as run() does."""
    from gradeflow.llm.common import stored

    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), f"test_{name}")
        out.append(docs.collect())
    return out


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    assert through(spark, docs, SF_SMALL) == [[]] * 5


def test_stages_on_null_empty_and_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*DOCUMENT_COLUMNS).limit(80)
    odd = [(9001, None, "en", "src0", None), (9002, "", None, None, 0), (None, "", "en", "src1", 0), (9003, "12 34 !!", "fr", "src2", 8), (9003, "12 34 !!", "fr", "src2", 8)]
    rows = docs.unionByName(docs.limit(20)).unionByName(spark.createDataFrame(odd, docs.schema))
    stages = through(spark, rows, SF_SMALL)
    ids = [r["doc_id"] for r in stages[0]]
    assert len(ids) > 80 and not {9001, 9002, 9003, None}.intersection(ids)  # no letter, no language
    ids = [r["doc_id"] for r in stages[1]]
    assert len(ids) == len(set(ids)) <= 80  # a repeated row is left once
    assert [len(s) for s in stages[2:]] == [len(ids), len(stages[3]), len(stages[3])] and 0 < len(stages[3]) <= len(ids)


def test_stages_after_one_that_leaves_nothing(spark):
    docs = spark.createDataFrame([(i, "1234 5678", "en", "src0", 9) for i in range(6)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert through(spark, docs, SF_SMALL) == [[]] * 5
