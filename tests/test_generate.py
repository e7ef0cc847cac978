"""Template generation invariants and the SFT JSONL sink."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from gradeflow.operators.generate import (
    DEFAULT_TEMPLATE_GROUPS,
    VALUE_NOT_VALID,
    generate,
    template_table,
    template_variables,
)
from gradeflow.session import scratch_path
from gradeflow.sources import io as IO
from gradeflow.sources import standins as S


def test_template_variables(spark):
    from gradeflow.plans.oracle_sql import GROUP_VARIABLES

    tv = {r["group_id"]: (r["n_templates"], r["vars"]) for r in template_variables(template_table(spark, DEFAULT_TEMPLATE_GROUPS)).collect()}
    assert tv == {gid: (len(g), v) for gid, (g, v) in enumerate(zip(DEFAULT_TEMPLATE_GROUPS, GROUP_VARIABLES))}
    plain = template_variables(template_table(spark, [[[{"role": "User", "content": "no slot"}, {"role": "Chatbot", "content": None}]]])).collect()
    assert [tuple(r) for r in plain] == [(0, 1, [])]


def test_other_message_keys_are_kept_and_nan_rejected(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 0.0), (3, 2.5)], "row_key long, v double")
    groups = [[[{"role": "User", "content": "v={{v}}", "name": "n", "weight": 3}, {"role": "Chatbot", "content": "no slot"}]]]
    acc, rej = generate(df, groups)
    assert sorted(r["row_key"] for r in rej.collect()) == [1, 2]
    (r,) = acc.collect()
    assert [m.asDict() for m in r["messages"]] == [{"role": "User", "content": "v=2.5", "name": "n", "weight": "3"}, {"role": "Chatbot", "content": "no slot", "name": None, "weight": None}]


def test_no_groups_give_nothing_and_many_templates_work(spark):
    df = spark.createDataFrame([(i, "w") for i in range(50)], "row_key long, word string")
    acc, rej = generate(df, [])
    assert acc.count() == rej.count() == 0
    many = [[[{"role": "User", "content": f"{i} {{{{word}}}}"}] for i in range(500)]]
    acc, _ = generate(df, many)
    assert acc.count() == 50 and acc.select("template_id").distinct().count() > 30


def test_accepted_plus_rejected_is_rows_times_groups(spark):
    d = S.dictionary(spark, SF_SMALL)
    acc, rej = generate(d, DEFAULT_TEMPLATE_GROUPS)
    n = d.count()
    assert acc.count() + rej.count() == n * len(DEFAULT_TEMPLATE_GROUPS)
    assert {r["reason"] for r in rej.select("reason").distinct().collect()} == {VALUE_NOT_VALID}
    # every slot is filled in accepted records
    leftover = acc.select(F.explode("messages").alias("m")).filter(F.col("m.content").contains("{{")).count()
    assert leftover == 0


def test_missing_column_is_variable_not_found(spark):
    df = spark.createDataFrame([(1, "w")], "row_key long, word string")
    groups = [[[{"role": "User", "content": "{{word}} {{meaning}}"}]]]
    acc, rej = generate(df, groups)
    r = rej.collect()[0]
    assert acc.count() == 0 and r["variable"] == "meaning" and r["reason"] == "variable not found"


def test_first_bad_variable_in_sorted_order_and_blank_kept(spark):
    df = spark.createDataFrame([(1, None, ""), (2, " ", "x")], "row_key long, a string, b string")
    groups = [[[{"role": "User", "content": "{{b}} {{a}}"}]]]
    acc, rej = generate(df, groups)
    assert [(r["row_key"], r["variable"]) for r in rej.collect()] == [(1, "a")]
    assert acc.collect()[0]["messages"][0]["content"] == "x  "


def test_pick_is_partition_independent(spark):
    d = S.dictionary(spark, SF_SMALL)
    a1, _ = generate(d.repartition(1), DEFAULT_TEMPLATE_GROUPS, seed=7)
    a2, _ = generate(d.repartition(7), DEFAULT_TEMPLATE_GROUPS, seed=7)
    k = ["row_key", "group_id", "template_id"]
    assert sorted(a1.select(*k).collect()) == sorted(a2.select(*k).collect())


def test_sft_jsonl_roundtrip_keeps_burmese(spark):
    df = spark.createDataFrame([(1, "မြန်မာ", "စာ")], "row_key long, word string, meaning string")
    acc, _ = generate(df, DEFAULT_TEMPLATE_GROUPS[:1])
    path = scratch_path(spark, "sft")
    IO.write_sft_jsonl(acc, path)
    text = "".join(r["value"] for r in spark.read.text(path).collect())
    assert "မြန်မာ" in text and "\\u" not in text
    back = IO.read_sft_jsonl(spark, path).collect()
    assert back[0]["messages"] == acc.collect()[0]["messages"]


def test_sample_is_the_first_rows_in_hash_order(spark):
    import hashlib

    from gradeflow.operators.sample import sample_fixed

    docs = S.table(spark, SF_SMALL, "documents").select("doc_id")
    ids = [r["doc_id"] for r in docs.collect()]
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{i}|3".encode()).hexdigest(), i))
    for n in (1, 37, 150, 10_000):
        assert sorted(r["doc_id"] for r in sample_fixed(docs, "doc_id", n, 3).collect()) == sorted(order[:n])
        assert sorted(r["doc_id"] for r in sample_fixed(docs.repartition(7), "doc_id", n, 3).collect()) == sorted(order[:n])
    twice = docs.unionAll(docs)
    assert sample_fixed(twice, "doc_id", 41, 3).count() == 41 and sample_fixed(docs, "doc_id", None).count() == len(ids)


def test_corpus_variables_match_python(spark):
    import re

    from gradeflow.operators.generate import corpus_variables

    rows = [("s1", "Hi {{name}}, {{ age }} and {{name}}"), ("s1", "none {{name}}"), ("s2", "{{a}}\n{{b}} {{x\ny}}"), ("s2", None)]
    got = {tuple(r) for r in corpus_variables(spark.createDataFrame(rows, "source string, text string"), "text", "source").collect()}
    want = {}
    for src, text in rows:
        for name in set(re.findall(r"{{(.*?)}}", text or "")):
            want[src, name] = want.get((src, name), 0) + 1
    assert got == {(s, v, n) for (s, v), n in want.items()}


def test_materialized_pairs_give_same_split(spark):
    d = S.dictionary(spark, SF_SMALL)
    a1, r1 = generate(d, DEFAULT_TEMPLATE_GROUPS)
    a2, r2 = generate(d, DEFAULT_TEMPLATE_GROUPS, materialize_pairs=True)
    assert sorted(a1.collect()) == sorted(a2.collect()) and sorted(r1.collect()) == sorted(r2.collect())


def test_rows_are_never_the_broadcast_side(spark):
    path = scratch_path(spark, "words")
    spark.range(20000).selectExpr("id row_key", "'w' word", "'m' meaning", "'p' phonetics", "'o' origin", "'noun' pos").write.parquet(path)
    for part, n in zip(generate(spark.read.parquet(path)), (100000, 0)):
        plan = part._jdf.queryExecution().sparkPlan().toString()
        assert "BuildLeft" not in plan and "SortMergeJoin" not in plan and plan.count("BuildRight") == 2
        assert part.count() == n
