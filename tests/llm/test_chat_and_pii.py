"""Chat formatting and PII surrogates."""

import hashlib
import re

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from gradeflow.llm import chatformat, registry, surrogates
from oracle_check import duck, rows_of


def python_nodes(df):
    return re.findall("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_chat_query_equals_sql(spark):
    for sf in (SF_SMALL, SF_MID):
        got = registry.op7_chat_format(spark, sf)
        assert rows_of(got.toPandas()) == rows_of(duck(sf).execute(chatformat.SQL).df())
        assert not python_nodes(got)


def test_chat_round_trip_and_edge_cases(spark):
    text = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 2, "assistant", text), (1, 1, "user", None), (1, 3, "assistant", "<\\|im_sep|>"), (1, 4, "a\n%0A<|", "<|\\|>"), (1, 4, "a\n%0A<|", "<|\\|>"),
        (2, None, "user", "z"), (2, 0, None, ""), (None, 1, "assistant", "lost"), (3, 1, "assistant", "x" * 100_000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    out = chatformat.formatted(df)
    back = {r.conv_id: [(t.role, t.text) for t in r.b] for r in out.select("conv_id", chatformat.read_back(F.col("formatted")).alias("b")).collect()}
    assert back == {
        1: [("user", ""), ("assistant", text), ("assistant", "<\\|im_sep|>"), ("a\n%0A<|", "<|\\|>"), ("a\n%0A<|", "<|\\|>")],
        2: [("user", "z"), ("", "")],
        None: [("assistant", "lost")],
        3: [("assistant", "x" * 100_000)],
    }
    got = {r.conv_id: r for r in chatformat.digests(out).collect()}
    assert got[1].loss_chars == len(text) + len("<\\|im_sep|>") and got[1].loss_sha256 == hashlib.sha256((text + "<\\|im_sep|>").encode()).hexdigest()
    whole = {r.conv_id: r.formatted for r in out.collect()}
    assert whole[1].count("<|im_start|>") == 3 and whole[1].count("<|im_sep|>") == 2  # adjacent turns of a role are merged
    assert chatformat.digests(chatformat.formatted(df.limit(0))).count() == 0


def replaced(spark, texts, key="k", **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in surrogates.replace_pii(df, key, **more).orderBy("doc_id").collect()]


def luhn(digits):
    ds = [int(c) for c in digits][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(ds)) % 10 == 0


def test_formats_and_coreference(spark):
    a, b, c, d, e = replaced(spark, [
        "write to jo.b7@mail5.example.com, Jo.B7@mail5.example.com.", "call +1 (743) 555-3824 or 743-555-3824!",
        "cards 4111111111111111 4111-1111-1111-1111 and 4111111111111112", "Mrs. Anna Schmidt, Mr. SCHMIDT and John Schmidt", "at 10.2.3.4. In v2.0.1",
    ])
    m = re.fullmatch(r"write to (\S+), (\S+)\.", a)
    assert m[1] == m[2] != "jo.b7@mail5.example.com" and re.fullmatch(r"[a-z]{2}\.[a-z][0-9]@[a-z]{8}\.example\.com", m[1])
    m = re.fullmatch(r"call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4})!", b)
    assert m.groups()[:3] == m.groups()[3:] != ("743", "555", "3824")
    m = re.fullmatch(r"cards (\d{16}) ((?:\d{4}-?){4}) and 4111111111111112", c)
    assert m[1] == m[2].replace("-", "") and luhn(m[1]) and m[1][0] == "4" and m[1] != "4111111111111111"
    m = re.fullmatch(r"Mrs\. (\w+) (\w+), Mr\. (\w+) and (\w+) (\w+)", d)
    assert m[1] in surrogates.GIVEN["latin_f"] and m[1] != "Anna" and m[4] in surrogates.GIVEN["latin_m"] and m[4] != "John"
    assert m[2] == m[5] == m[3].capitalize() != "Schmidt" and m[3].isupper()
    m = re.fullmatch(r"at (\d+\.\d+\.\d+\.\d+)\. In v2\.0\.1", e)
    assert m[1] != "10.2.3.4" and all(int(x) < 256 for x in m[1].split("."))


def test_script_and_gender(spark):
    a, b = replaced(spark, ["Вчера Анна Иванова и Иван Петров", "Ελένη Παππά"])
    m = re.fullmatch(r"Вчера (\w+) (\w+) и (\w+) (\w+)", a)
    assert m[1] in surrogates.GIVEN["cyrillic_f"] and m[3] in surrogates.GIVEN["cyrillic_m"] and m[2].endswith("а") and not m[4].endswith("а")
    assert re.fullmatch(r"[А-Я][а-я]+", m[2]) and m[2] != "Иванова"
    assert b.split()[0] in surrogates.GIVEN["greek_f"] and re.fullmatch(r"[Α-Ω][α-ωά]+", b.split()[1])


def test_edge_cases(spark):
    texts = [None, "", "clean text 42 and 1.5", "x" * 100_000, "a@b.co " * 2000, "dup 10.0.0.1", "dup 10.0.0.1", "no @ here", "4111111111111112"]
    got = replaced(spark, texts, count="n")
    assert got[:4] == texts[:4] and got[7:] == texts[7:] and got[5] == got[6] != texts[5]
    assert len(set(got[4].split())) == 1 and len(got[4].split()) == 2000
    df = spark.createDataFrame([(1, "a@b.co", 5)], "doc_id long, text string, _found int").withColumn("attempt", F.lit(7))
    out = surrogates.replace_pii(df.withColumnRenamed("_found", "kind"), "k")
    assert out.columns == ["doc_id", "text", "kind", "attempt"] and out.first().kind == 5
    assert surrogates.replace_pii(df.limit(0), "k").count() == 0


def test_phone_numbers_of_other_countries(spark):
    numbers = ["+33 6 12 34 56 78", "06 12 34 56 78", "0612345678", "+49 30 1234567", "030/1234567", "+49 (0) 30 1234567", "+34 612 345 678", "+44 20 7946 0958", "+442079460958", "0033 6 12 34 56 78", "+7 (495) 123-45-67", "+351 12345 6789012"]
    got = replaced(spark, [f"Tel. {n}, bitte" for n in numbers])
    for old, new in zip(numbers, got):
        new = re.fullmatch(r"Tel\. (.*), bitte", new)[1]
        assert new != old and re.sub("[0-9]", "9", new) == re.sub("[0-9]", "9", old)
        assert new[: 3 if old[0] == "+" and old[1] != "7" else 1] == old[: 3 if old[0] == "+" and old[1] != "7" else 1]
        # hardly a digit after the code stays by chance
        assert sum(a != b for a, b in zip(old, new)) >= 5
    assert len({re.sub(r"\D", "", t)[-9:] for t in (got[0], got[1], got[2], got[9])}) == 1
    kept = ["on 01.02.2024 12:30", "0.123456789", "id 1700000000", "05 12", "am 02/03/2024 10 Uhr", "v0123456789x", "4111111111111112"]
    assert replaced(spark, kept) == kept


def test_addresses_with_letters_beyond_ascii(spark):
    a, b, c, d = replaced(spark, ["an jürgen.müller@mail5.example.com.", "пишите иван@почта.рф, да", "JÜRGEN.MÜLLER@mail5.example.com", "见a.b@c.org谢谢"])
    m = re.fullmatch(r"an ([a-z]{6}\.[a-z]{6}@[a-z]{8}\.example\.com)\.", a)
    assert m[1] == c and "ller" not in m[1]
    m = re.fullmatch(r"пишите ([а-я]{4})@[a-z]{8}\.example\.com, да", b)
    assert m[1] != "иван"
    assert re.fullmatch(r"见[a-z]\.[a-z]@[a-z]{8}\.example\.com谢谢", d)


def test_collisions_are_keyed_again(spark):
    """One-letter addresses of one host have 26 surrogates: chance alone would not part 20."""
    texts = [f"{c}@x.org" for c in "abcdefghijklmnopqrst"]
    got = replaced(spark, texts)
    assert len(set(got)) == 20 and not set(got) & set(texts)
    assert got == replaced(spark, texts) != replaced(spark, texts, key="other")


def test_query_is_native_and_distinct(spark):
    got = registry.op5_pii_surrogates(spark, SF_SMALL)
    assert not python_nodes(got)
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    entity = re.compile(r"(?<![\w.+%-])[\w.+%-]+@(?:[a-z0-9-]+\.)+[a-z]+|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)")
    mapped = {}
    for r in got.collect():
        old, new = entity.findall(before[r.doc_id]), entity.findall(r.text)
        old = [e for e in old if not re.fullmatch(r"\d{16}", e) or luhn(e)]
        new = [e for e in new if not re.fullmatch(r"\d{16}", e) or luhn(e)]
        assert len(old) == len(new) == r.n_entities
        assert (r.text == before[r.doc_id]) == (not old)
        for a, b in zip(old, new):
            assert mapped.setdefault(a, b) == b != a
    assert len(mapped) > 5 and len(set(mapped.values())) == len(mapped) and not set(mapped) & set(mapped.values())
