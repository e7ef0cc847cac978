"""Quality, language ID and their features: held-out accuracy and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from gradeflow.llm import langid, quality, registry
from gradeflow.llm.common import held_out
from gradeflow.llm.subword import Features, bags, feature_ids, logits, softmax, train


def plain_features(text, spec):
    """The number of features of a text, counted one by one."""
    tokens = text.split()
    n = len(tokens) if spec.words else 0
    if spec.repeats:
        n += sum(a == b for a, b in zip(tokens, tokens[1:]))
    for t in tokens:
        for k in spec.ngrams:
            n += max(0, len(t) + 2 - k + 1)
    return n


@pytest.mark.parametrize("spec", [Features((2, 3, 4), True, False, 16), Features((3, 4), True, False, 16, True), Features((2,), False, False, 12)])
def test_feature_counts_match_a_plain_count(spec):
    texts = ["abc de", "", None, "x", "rep rep rep end", " lead  two\nlines ", "é ü 😀😀"]
    counts = np.zeros(len(texts), int)
    for own, _ in feature_ids(texts, spec):
        counts += np.bincount(own, minlength=len(texts))
    assert counts.tolist() == [plain_features(t or "", spec) for t in texts]


def test_scores_do_not_depend_on_the_batch():
    spec = Features((3, 4), True, False, 14, True)
    texts = ["one two three", "four five " * 50_000, "six", None, "y" * 300_000, "seven eight"]
    table = np.random.default_rng(1).normal(size=(1 << 14, 2)).astype(np.float32)
    together = logits(texts, table, spec)
    for i, t in enumerate(texts):
        assert np.allclose(together[i], logits([t], table, spec)[0])


def test_folded_table_equals_the_mean_of_the_rows():
    spec = Features((3,), True, False, 12)
    table = train(bags(["aa bb", "cc dd"], spec), np.array([0, 1]), 2, spec, epochs=30)
    (ids, share), = bags(["aa dd"], spec)
    assert np.allclose(share @ table[ids], logits(["aa dd"], table, spec)[0], atol=1e-5)
    assert softmax(logits(["aa bb", "cc dd"], table, spec)).argmax(axis=1).tolist() == [0, 1]


def test_quality_on_held_out_rows(spark):
    got = registry.op1_quality_classifier(spark, SF_MID)
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").select("doc_id", "quality")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert got.count() == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    assert got.filter("score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0


def test_language_on_held_out_rows(spark):
    got = registry.op10_language_id(spark, SF_MID)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.01


def test_languages_rejected_and_edge_cases(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.fit(docs)
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "中文字符的句子"), (None, "the of and that"), (6, "the " * 100_000), (6, "the " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("lang_pred", F.lit(1))
    got = [(r.doc_id, r.lang_pred, r.rejected) for r in langid.identify(df, model).collect()]
    assert got[:3] == [(1, "und", True), (2, "und", True), (3, "und", True)]
    assert got[3][2] is True and got[4] == (None, "en", False) and got[5] == got[6] == (6, "en", False)
    assert langid.keep_identified(df, model).columns == df.columns
    assert langid.identify(df.limit(0), model).count() == 0
    nothing = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}


#: One sentence each in languages that no table labels, all in Latin script.
UNLEARNED = [
    "La ragazza cammina lungo la strada e guarda le vetrine dei negozi prima di tornare a casa.",
    "Dziewczyna idzie ulicą i patrzy na wystawy sklepów, zanim wróci do domu.",
    "Tyttö kävelee katua pitkin ja katselee kauppojen ikkunoita ennen kuin palaa kotiin.",
    "Het meisje loopt door de straat en kijkt naar de etalages voordat ze naar huis gaat.",
    "Kız sokakta yürüyor ve eve dönmeden önce dükkanların vitrinlerine bakıyor.",
    "Flickan går längs gatan och tittar i skyltfönstren innan hon går hem igen.",
]


def test_unlearned_languages_of_the_same_script_are_rejected(spark):
    docs = spark.read.parquet(f"{SF_MID.replace('sf0.01', 'sf0.1')}/documents.parquet")
    model = langid.fit(docs)
    assert model.predict(UNLEARNED)[2].all()
    # and the texts of known languages stay, whole or mixed
    rows = docs.filter(held_out(F.col("doc_id"))).select("lang", "text").orderBy("doc_id").collect()
    assert model.predict([r.text for r in rows])[2].mean() < 0.005
    pairs = [(a.text.split(), b.text.split()) for a, b in zip(rows, rows[1:]) if a.lang != b.lang]
    both = [" ".join(a[: min(len(a), len(b))] + b[: min(len(a), len(b))]) for a, b in pairs]
    assert len(both) > 500 and model.predict(both)[2].mean() < 0.005


def test_rare_languages_are_learned(spark):
    """Ten rows of 40,000: an even draw of 6,000 learning rows would hold one or two, or none."""
    words = "the of and that with from this have not are which were been their would".split()
    rare = "και του της από στην για που δεν είναι ένα αυτό στο".split()
    rows = [(i, " ".join(words[i * k % 15] for k in range(3, 15)), "en") if i % 4000 else (i, " ".join(rare[(i // 4000 + k) % 12] for k in range(10)), "el") for i in range(40_000)]
    docs = spark.createDataFrame([*rows, (50_000, None, "it"), (50_001, "12 34", "it"), (50_002, "senza lingua", None)], "doc_id long, text string, lang string")
    sample = langid.sample_per_language(docs, 600, 300)
    assert len(sample) == 600 and 5 <= sum(v == "el" for v, _ in sample) <= 10 and sample == langid.sample_per_language(docs.repartition(5), 600, 300)
    model = langid.fit(docs, max_train=300, max_check=300)
    langs, _, rejected = model.predict([" ".join(rare), " ".join(words)])
    assert model.langs == ("el", "en") and langs == ["el", "en"] and not rejected.any()
    with pytest.warns(UserWarning, match="rarest"):
        assert langid.fit(docs, max_train=1, max_check=0).langs == ("en",)


def test_rows_are_dealt_evenly():
    assert langid.dealt({"a": 10_000, "b": 5, "c": 800, "d": 9000}, 3000) == {"b": 5, "c": 800, "d": 1097, "a": 1098}
    assert langid.dealt({"a": 2, "b": 3}, 100) == {"a": 2, "b": 3}


def test_few_ngrams_are_seen_by_chance(spark):
    """Random letters of a script that was not learned."""
    model = langid.fit(spark.read.parquet(f"{SF_MID}/documents.parquet"))
    letters = np.random.default_rng(2).integers(0x4E00, 0x9FA5, 30_000)
    share = langid.measures(["".join(map(chr, letters))], model.table, model.seen, model.spec)[1][0]
    assert share < 0.01


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (4, "x " * 50_000)], "doc_id long, text string").withColumn("score", F.lit(9))
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 0), (None, 1), (2, None)], "doc_id long, quality int")
    rows = quality.classify(docs, quality.fit(docs, labels)).collect()
    assert [r.doc_id for r in rows] == [1, 2, None, 4] and rows[0].score == rows[1].score == 0.5 and not rows[2].held_out
    empty = quality.fit(docs.limit(0), labels.limit(0))
    assert {r.score for r in quality.classify(docs, empty).collect()} == {0.5}


def test_labels_of_held_out_rows_are_never_read(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, turned)
    assert np.array_equal(a.table, b.table)
