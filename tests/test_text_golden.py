"""Golden cases (Python ``re`` / ``str`` semantics) for the scalar functions."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradeflow.fixed_values import ANSWER_HEAD, FIB_TAIL, MCQ_TAIL, RESPONSE_REMOVALS, TOF_TAIL
from gradeflow.functions import extract as X
from gradeflow.functions import score as SC
from gradeflow.functions import text as TX

NL = "\n"


def one(spark, expr, value, extra=None):
    cols = "t string" + (", a string" if extra is not None else "")
    row = (value,) if extra is None else (value, extra)
    return spark.createDataFrame([row], cols).select(expr.alias("x")).collect()[0]["x"]


def py_search(pattern, text, group=1):
    m = re.search(pattern, text)
    return m.group(group) if m else None


MCQ_CASES = [
    ("အဖြေ: က", "A"),
    ("အဖြေ : (ခ)", "B"),
    ("အဖြေ:" + NL + NL + "ဂ", "C"),
    ("အဖြေ:" + NL * 3 + "ဂ", None),
    ("အဖြေ : ဃ", "D"),
    ("အဖြေ\u001c: က", "A"),
    ("အဖြေ: င", None),
    ("အဖြေ: က … အဖြေ: ခ", "A"),
]


@pytest.mark.parametrize("text,expected", MCQ_CASES)
def test_mcq_extract(spark, text, expected):
    assert one(spark, X.extract_mcq(F.col("t")), text) == expected


def test_exam_mcq_row_answer(spark):
    # The row's own answer is an alternative, case-insensitively; 'a' != 'A' scores 0.
    got = one(spark, X.extract_exam_mcq(F.col("t"), F.col("a")), "အဖြေ: a", "A")
    assert got == "a"
    # An uncommon answer takes the per-row pattern path, quoted literally.
    assert one(spark, X.extract_exam_mcq(F.col("t"), F.col("a")), "အဖြေ: (x+y)", "x+y") == "x+y"
    assert one(spark, X.extract_exam_mcq(F.col("t"), F.col("a")), "အဖြေ: xxy", "x+y") is None


@pytest.mark.parametrize(
    "text,expected",
    [("အဖြေ: (မှား)", "မှား"), ("အဖြေ: ဟုတ်", None), ("အဖြေ:မှန်", "မှန်")],
)
def test_tof_extract(spark, text, expected):
    assert one(spark, X.extract_tof(F.col("t")), text) == expected


FIB_CASES = [
    ("အဖြေ: (စာ)", "စာ"),
    ("အဖြေ: (စာ)" + NL, "စာ"),
    ("အဖြေ: စာ" + NL + "နောက်", None),
    ("အဖြေ:", ""),
    ("အဖြေ: စာ  ", "စာ  "),
    ("အဖြေ: စာ\r" + NL, "စာ\r"),
    ("အဖြေ: a b", "a b"),
    ("အဖြေ: တစ် အဖြေ: နှစ်", "တစ် အဖြေ: နှစ်"),
]


@pytest.mark.parametrize("text,expected", FIB_CASES)
def test_fib_extract(spark, text, expected):
    assert one(spark, X.extract_fib(F.col("t")), text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ("**အဖြေ: က**", "အဖြေ: က"),
        ("$\\boxed{က}$", "က"),
        ("\\boxed{က}", "က}"),
        ("\\(\\text{ခ}\\)", "ခ}\\)"),
        ("\\$5", "5"),
        ("{{x}}", "x}}"),
        ("$\\mathbf{A}$", "A"),
    ],
)
def test_normalize_response(spark, text, expected):
    assert one(spark, TX.normalize_response(F.col("t")), text) == expected


def test_strip(spark):
    assert one(spark, TX.py_strip(F.col("t")), "  x\n\t\u001c") == "x"
    assert one(spark, TX.py_strip(F.col("t")), "​") == "​"


def test_rubric_digits_and_range(spark):
    g = SC.parse_rubric(F.col("t"))
    r = one(spark, g, "Content Relevancy: ၃\nRegister Appropriateness: 2\nGrammatical and Syntactic Competence: 4")
    assert (r["content"], r["register"], r["grammar"], r["valid"]) == (3, 2, 4, True)
    r = one(spark, g, "Content Relevancy: 99999999999\nRegister Appropriateness: 2\nGrammatical and Syntactic Competence: 4")
    assert r["content"] is None and r["valid"] is False
    r = one(spark, g, "Content Relevancy: 3\nRegister Appropriateness: 2\nGrammatical and Syntactic Competence: 0")
    assert r["valid"] is False


def test_exact_match_nullsafe(spark):
    df = spark.createDataFrame([(None, None), ("A", None), ("A", "A"), ("B", "A")], "e string, a string")
    got = [r["s"] for r in df.select(SC.exact_match(F.col("e"), F.col("a")).alias("s")).collect()]
    assert got == [1.0, 0.0, 1.0, 0.0]


def test_population_std(spark):
    from gradeflow.operators.aggregate import aggregate_results

    df = spark.createDataFrame([(float(v),) for v in [1, 0, 0, 1, 1]], "score double").select(
        F.create_map().cast("map<string,double>").alias("metrics"), "score"
    )
    out = {r["metric"]: r["value"] for r in aggregate_results(df).collect()}
    assert out["score"] == pytest.approx(0.6)
    assert out["score:std"] == pytest.approx(0.48989794855663565)
    one_row = spark.createDataFrame([(1.0,)], "score double").select(F.create_map().cast("map<string,double>").alias("metrics"), "score")
    assert {r["metric"]: r["value"] for r in aggregate_results(one_row).collect()}["score:std"] == 0.0


def test_unknown_stat_rejected(spark):
    from gradeflow.operators.aggregate import aggregate_results

    df = spark.createDataFrame([(1.0,)], "score double").select(F.create_map().cast("map<string,double>").alias("metrics"), "score")
    with pytest.raises(ValueError):
        aggregate_results(df, default_stats=("median",))


def test_judge_and_html(spark):
    assert one(spark, TX.judge_verdict(F.col("t")), " Yes\n") is True
    assert one(spark, TX.judge_verdict(F.col("t")), "yes.") is False
    html = one(spark, TX.message_html(F.lit("user"), F.col("t")), "<a href='x'>&\"")
    assert "&lt;a href=&#39;x&#39;&gt;&amp;&#34;" in html


# --- property test: Spark extraction equals Python re on random responses ---------

ALPHABET = list("အဖြေ:() \t\n\r \u001cကခဂဃငမှန်ားAaBb$*{}\\") + ["အဖြေ", "မှန်", "မှား", " "]
PY_MCQ = "(?i)" + ANSWER_HEAD + MCQ_TAIL
PY_TOF = "(?i)" + ANSWER_HEAD + TOF_TAIL
PY_FIB = "(?i)" + ANSWER_HEAD + FIB_TAIL


def py_normalize(s):
    for r in RESPONSE_REMOVALS:
        s = s.replace(r, "")
    return s


def py_norm_answer(s):
    for a, b in zip("ကခဂဃ", "ABCD"):
        s = s.replace(a, " " + b)
    return s.strip()


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=14).map("".join), min_size=20, max_size=20))
def test_extraction_matches_python_re(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    n = TX.normalize_response(F.col("t"))
    rows = df.select(
        "t",
        n.alias("n"),
        X.extract_mcq(n).alias("mcq"),
        X.extract_tof(n).alias("tof"),
        X.extract_fib(n).alias("fib"),
    ).collect()
    for r in rows:
        t = r["t"]
        pn = py_normalize(t)
        assert r["n"] == pn
        m = py_search(PY_MCQ, pn)
        assert r["mcq"] == (py_norm_answer(m) if m is not None else None), t
        assert r["tof"] == py_search(PY_TOF, pn), t
        assert r["fib"] == py_search(PY_FIB, pn), t


ANSWERS = ["A", "B", "C", "D", None, "x", "Brand#1", "မှန်", "ski [.*", "ခရု", "က", "", " x", "(x", "É"]


@settings(max_examples=20, deadline=None)
@given(
    st.lists(
        st.tuples(st.lists(st.sampled_from(ALPHABET + ["x", "Brand#1", "a", "d", "အဖြေ:", "အဖြေ :", "SKI [.*", "ſkı [.*", "ခရု", "é"]), max_size=12).map("".join), st.sampled_from(ANSWERS)),
        min_size=20,
        max_size=20,
    )
)
def test_exam_mcq_matches_python_re(spark, rows):
    """Constant patterns for common answers == the per-row pattern == Python ``re``."""
    df = spark.createDataFrame(rows, "t string, a string")
    n = TX.normalize_response(F.col("t"))
    got = df.select("t", "a", X.extract_exam_mcq(n, F.col("a")).alias("x")).collect()
    head_tail = MCQ_TAIL[: MCQ_TAIL.index("[ဃ])") + len("[ဃ]")]
    for r in got:
        answer = "None" if r["a"] is None else r["a"]
        pattern = "(?i)" + ANSWER_HEAD + head_tail + "|" + re.escape(answer) + ")(?:\\))?"
        m = py_search(pattern, py_normalize(r["t"]))
        want = (py_norm_answer(m) if m else m) if m is not None else None
        assert r["x"] == want, (r["t"], r["a"])
