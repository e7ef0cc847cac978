"""Row positions, versioned tables, shared replies, retry rounds, call windows, split CSV files."""

import csv
import os
import random
import re
import threading
import time

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from gradeflow.functions.text import message_html
from gradeflow.operators import report
from gradeflow.operators.distil import distil_by_position, distil_in_place, run_distillation
from gradeflow.operators.inference import CallPolicy, CallWindow, _sliding, batch_chat, call_in_rounds, retry_rate_limit
from gradeflow.operators.prompts import pack_messages
from gradeflow.operators.replies import best_replies, call_stored, stored_replies
from gradeflow.operators.report import write_report_files, write_reports
from gradeflow.operators.sample import sample_positions
from gradeflow.plans import whole_tables
from gradeflow.plans.evals import run
from gradeflow.session import scratch_path
from gradeflow.sources import csv_split
from gradeflow.sources import io as IO
from gradeflow.sources import standins as S
from gradeflow.sources import versions as V
from gradeflow.sources.csv_split import read_csv_split
from gradeflow.sources.positions import from_files, in_order, with_positions

NO_WAIT = CallPolicy(max_attempts=1, backoff_base=0)


def echo(messages):
    return "re " + messages[-1]["content"]


# --- positions -------------------------------------------------------------------


def test_positions_follow_files_and_lines(spark):
    path = scratch_path(spark, "lines")
    in_order(spark.range(5000).selectExpr("cast(id as string) value"), "value", num_partitions=3).write.text(path)
    want = []
    for name in sorted(f for f in os.listdir(path) if f.startswith("part-")):
        with open(f"{path}/{name}", encoding="utf-8") as fh:
            want += fh.read().splitlines()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = from_files(spark.read.text(path))
        assert rows.rdd.getNumPartitions() > 3
        placed = with_positions(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["value"] for r in placed.orderBy("position").collect()] == want
    assert sorted(r["position"] for r in placed.collect()) == list(range(5000))


def test_rows_are_not_moved_to_be_numbered(spark):
    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for size in ("-1", "1g"):  # whatever Spark makes of the size of the rows' files
            spark.conf.set(key, size)
            placed = with_positions(spark.range(5000).repartition(3))
            plan = placed._jdf.queryExecution().sparkPlan().toString()
            assert "BuildRight" in plan and "BuildLeft" not in plan and "SortMergeJoin" not in plan
            assert sorted(r["position"] for r in placed.collect()) == list(range(5000))
    finally:
        spark.conf.set(key, old)


def test_positions_of_equal_rows_and_empty_tables(spark):
    rows = spark.createDataFrame([("x", None)] * 7, "a string, `b.c` int").repartition(3)
    placed = with_positions(rows)
    assert sorted(r["position"] for r in placed.collect()) == list(range(7)) and placed.columns == ["position", "a", "b.c"]
    assert with_positions(rows.limit(0)).count() == 0
    with pytest.raises(ValueError, match="already"):
        with_positions(placed)


def test_sample_positions_is_pythons_sample(spark):
    placed = with_positions(spark.range(300).coalesce(1))
    for n in (1, 17, 300):
        assert sorted(r["id"] for r in sample_positions(placed, n, 0).collect()) == sorted(random.Random(0).sample(list(range(300)), n))
    assert sample_positions(placed, None).count() == 300
    assert sample_positions(placed, 400, capped=True).count() == 300
    with pytest.raises(ValueError):
        sample_positions(placed, 301)


def test_distil_by_position_calls_equal_rows_apart(spark):
    rows = spark.createDataFrame([("same", None)] * 6 + [("other", "kept")] + [("", None)], "prompt string, output string").coalesce(1)
    path = scratch_path(spark, "by_position")
    out = distil_by_position(rows, echo, results_path=path, policy=NO_WAIT, n_chunks=2)
    got = [(r["prompt"], r["output"]) for r in out.final.orderBy("position").collect()]
    assert got == [("same", "re same")] * 6 + [("other", "kept"), ("", None)]
    s = out.stats.first()
    assert (s["total_rows"], s["processed"], s["errors"], s["skipped"], s["calls"]) == (8, 6, 1, 1, 6)
    assert [r["detail"] for r in out.errors.collect()] == ["Row 7: " + out.errors.first()["error"]]
    again = distil_by_position(rows, echo, results_path=path, policy=NO_WAIT, n_chunks=2)
    assert again.stats.first()["calls"] == 0


# --- replies -----------------------------------------------------------------------


def some_fail(messages):
    if "bad" in messages[-1]["content"]:
        raise RuntimeError("down")
    return echo(messages)


def test_equal_prompts_are_called_once(spark):
    texts = ["hot"] * 400 + [f"p{i % 40}" for i in range(200)] + ["bad"] * 5
    rows = spark.createDataFrame([(i % 3 if i % 7 else None, "m", t) for i, t in enumerate(texts)], "item_id int, model_name string, t string")
    rows = rows.withColumn("prompt_messages", pack_messages(F.col("t")))
    path = scratch_path(spark, "store")
    out = call_stored(rows, {"m": some_fail}, path, policy=NO_WAIT, n_chunks=3).collect()
    assert len(out) == 605 and all((r["response"] == "re " + r["t"]) if r["t"] != "bad" else r["error"] == "down" for r in out)
    assert stored_replies(spark, path).count() == 42
    again = call_stored(rows.withColumn("item_id", F.lit(9)), {"m": echo}, path, policy=NO_WAIT, n_chunks=3)
    assert {r["response"] for r in again.filter("t = 'bad'").collect()} == {"re bad"} and again.count() == 605
    assert stored_replies(spark, path).count() == 43  # only the failed prompt was called again
    assert best_replies(stored_replies(spark, path)).count() == 42
    with pytest.raises(ValueError, match="already"):
        call_stored(rows.withColumn("error", F.lit(1)), {"m": echo})
    assert call_stored(rows.limit(0), {"m": echo}).count() == 0


def test_settings_are_part_of_a_request(spark):
    rows = spark.createDataFrame([("m", "x")], "model_name string, t string").withColumn("prompt_messages", pack_messages(F.col("t")))
    path = scratch_path(spark, "settings")
    for settings in ("t=0", "t=1", "t=1"):
        call_stored(rows, {"m": echo}, path, settings=settings).collect()
    assert stored_replies(spark, path).count() == 2


def option(messages):
    return "အဖြေ: " + ("က" if "zebra" in messages[-1]["content"] else "ခ")


def test_items_with_repeated_and_missing_ids(spark):
    """Each of four items is asked and scored once, against its own answer."""
    rows = [(1, "zebra", "A"), (1, "second", "B"), (None, "zebra again", "A"), (2, "third", "A")]
    items = spark.createDataFrame([(i, None, q, "w", "x", "y", "z", a) for i, q, a in rows], "item_id int, sample_id string, question string, option_a string, option_b string, option_c string, option_d string, answer string")
    out = run({"m": option}, {"mmlu_lite": items}, policy=NO_WAIT)
    assert out.counts.first()["n_rows"] == 4
    got = sorted((str(r["item_id"]), r["answer"], r["score"]) for r in out.examples.collect())
    assert got == [("1", "A", 1.0), ("1", "B", 1.0), ("2", "A", 0.0), ("None", "A", 1.0)]
    exact = run({"m": option}, {"mmlu_lite": items.coalesce(1)}, policy=NO_WAIT, examples=2, sampling="position")
    assert sorted(r["item_pos"] for r in exact.examples.collect()) == sorted(random.Random(0).sample(range(4), 2))
    with pytest.raises(ValueError, match="sampling"):
        run({"m": option}, {"mmlu_lite": items}, sampling="other")


# --- rounds and windows -----------------------------------------------------------


def limited(messages):
    if "busy" in messages[-1]["content"]:
        raise RuntimeError("rate limit")
    if "bad" in messages[-1]["content"]:
        raise ValueError("no")
    return "ok"


def no_sleep(seconds):
    raise AssertionError("a task waited")


def test_rounds_wait_on_the_driver_only(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "fine"), (2, "busy"), (2, "busy"), (3, "bad"), (None, "fine")], "k int, t string").select("k", pack_messages(F.col("t")).alias("messages"))
    policy = CallPolicy(max_attempts=3, backoff_base=5.0, retryable=retry_rate_limit)
    policy.delay = no_sleep  # asked for only by a loop inside a task
    waits = []
    path = scratch_path(spark, "rounds")
    out = call_in_rounds(rows, limited, ["k"], policy=policy, path=path, pause=waits.append).collect()
    got = sorted(map(str, ((r["k"], r["response"], r["error"], r["attempts"]) for r in out)))
    assert got == sorted(map(str, [(1, "ok", None, 1), (None, "ok", None, 1), (2, None, "rate limit", 3), (2, None, "rate limit", 3), (3, None, "no", 1)]))
    # the first wait is the delay of one attempt with up to half of it more, the next of two
    assert len(waits) == 2 and 1.0 <= waits[0] <= 1.5 and 5.0 <= waits[1] <= 7.5
    tries = spark.read.parquet(f"{path}/tries")
    assert tries.count() == 5 + 2 + 2
    assert call_in_rounds(rows.limit(0), limited, ["k"], policy=policy).count() == 0


def test_runs_by_rounds(spark):
    """Distillation and shared replies with retries as later jobs: the same replies and attempts."""
    rows = spark.createDataFrame([(1, "fine"), (2, "busy"), (3, "bad")], "row_key int, prompt string")
    policy = CallPolicy(max_attempts=2, backoff_base=0.0, retryable=retry_rate_limit)
    one, other = (run_distillation(rows, limited, policy=policy, n_chunks=1, rounds=r) for r in (True, False))
    assert one.stats.first() == other.stats.first() and one.stats.first()["calls"] == 4
    asked = rows.select(F.lit("m").alias("model_name"), "row_key", pack_messages(F.col("prompt")).alias("prompt_messages"))
    found = [sorted(map(str, call_stored(asked, {"m": limited}, policy=policy, n_chunks=1, rounds=r).select("row_key", "response", "error", "attempts").collect())) for r in (True, False)]
    assert found[0] == found[1]


def test_a_slow_call_holds_up_no_other():
    """One slow call in each of four batches: others of later batches finish meanwhile."""
    import pyarrow as pa

    started, lock = [], threading.Lock()

    def chat(messages):
        with lock:
            started.append(messages)
        time.sleep(0.5 if messages % 10 == 0 else 0.001)
        return str(messages)

    batches = [pa.RecordBatch.from_arrays([pa.array(range(10 * b, 10 * b + 10))], names=["k"]) for b in range(4)]
    calls = lambda batch: [(chat, k) for k in batch.column("k").to_pylist()]
    begin = time.time()
    out = [r for b in _sliding(iter(batches), calls, NO_WAIT, 6, ["k"]) for r in b.to_pylist()]
    assert sorted((r["k"], r["response"], r["attempts"]) for r in out) == [(k, str(k), 1) for k in range(40)]
    assert time.time() - begin < 1.5  # one after the other the slow calls alone take 2 s
    assert [r["k"] for r in out] != list(range(40))


def test_window_narrows_at_the_limit():
    window = CallWindow(8)
    window.failed(ValueError("other"))
    assert window.size == 8
    for _ in range(2):
        window.failed(RuntimeError("Rate limit"))
    assert window.size == 2
    for _ in range(3):
        window.succeeded()
    assert 3 <= window.size < 4
    for _ in range(99):
        window.succeeded()
    assert window.size == 8
    for _ in range(9):
        window.failed(RuntimeError("limit"))
    assert window.size == 1


def test_window_keeps_keys_with_replies(spark):
    rows = spark.range(500).select(F.col("id").alias("k"), pack_messages(F.col("id").cast("string")).alias("messages"))
    got = batch_chat(rows, echo, ["k"], concurrency=7, num_partitions=2).collect()
    assert sorted((r["k"], r["response"]) for r in got) == [(k, f"re {k}") for k in range(500)]


# --- versions ----------------------------------------------------------------------


def table(spark, n=40, buckets=4):
    root = scratch_path(spark, "versions")
    rows = spark.range(n).select("id", F.col("id").cast("string").alias("prompt"), F.when(F.col("id") % 5 == 0, F.lit("old")).alias("output"))
    V.create(rows, root, F.col("id"), buckets)
    return root


def filled(spark, root, number=None):
    return {r["id"]: r["output"] for r in V.read(spark, root, number).collect()}


def test_each_save_is_a_whole_table(spark):
    root = table(spark)
    out = distil_in_place(spark, root, echo, policy=NO_WAIT)
    assert out.versions == [1, 2, 3, 4] and out.errors.count() == 0
    for v in range(5):
        assert filled(spark, root, v) == {i: "old" if i % 5 == 0 else f"re {i}" if i % 4 < v else None for i in range(40)}
    files = [V.load(spark, root, v).files for v in range(5)]
    assert all(files[v + 1][b] == files[v][b] for v in range(4) for b in range(4) if b != v)
    assert distil_in_place(spark, root, echo, policy=NO_WAIT).versions == []  # nothing is blank


def test_a_crash_before_the_commit_changes_nothing(spark):
    root = table(spark)

    def crash():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        distil_in_place(spark, root, echo, policy=NO_WAIT, before_commit=crash)
    assert V.versions(spark, root) == [0] and sum(v is None for v in filled(spark, root).values()) == 32
    # a manifest cut short is no version, and the next writer goes past it
    with open(f"{root}/_versions/v{1:012d}.json", "w") as f:
        f.write('{"number": 1, "sch')
    assert V.current(spark, root).number == 0
    with pytest.raises(V.VersionConflict):
        distil_in_place(spark, root, echo, policy=NO_WAIT)


def test_of_two_writers_one_wins(spark):
    root = table(spark)
    base = V.current(spark, root)
    V.rewrite(spark, root, base, 0, lambda rows: rows.withColumn("output", F.lit("a")))
    with pytest.raises(V.VersionConflict):
        V.rewrite(spark, root, base, 1, lambda rows: rows.withColumn("output", F.lit("b")))
    assert set(filled(spark, root).values()) == {"a", "old", None}


def test_failed_calls_stay_blank_and_are_counted(spark):
    root = scratch_path(spark, "versions")
    rows = spark.createDataFrame([("bad", None), ("bad", " "), ("x", None), ("x", None), ("", None)], "prompt string, output string")
    V.create(rows, root, F.lit(0), 2)
    out = distil_in_place(spark, root, some_fail, policy=NO_WAIT)
    assert sorted(map(str, (tuple(r) for r in V.read(spark, root).collect()))) == sorted(map(str, [("bad", None), ("bad", " "), ("x", "re x"), ("x", "re x"), ("", None)]))
    assert {(r["error"], r["n"]) for r in out.errors.collect()} >= {("down", 2)}
    assert distil_in_place(spark, root, echo, policy=NO_WAIT).versions == [2]
    with pytest.raises(ValueError, match="no column"):
        distil_in_place(spark, root, echo, output_column="nothing")
    with pytest.raises(FileNotFoundError):
        V.current(spark, scratch_path(spark, "none"))


# --- files -------------------------------------------------------------------------


def test_split_csv_equals_the_multi_line_reader(spark):
    r = random.Random(3)
    folder = scratch_path(spark, "split_csv").replace("file:", "")
    os.makedirs(folder)
    for name in ("a.csv", "b.csv"):
        with open(f"{folder}/{name}", "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f, lineterminator="\n")
            w.writerow(["id", "t", "u"])
            for i in range(300):
                w.writerow([i, "".join(r.choice('ab,"\n x') for _ in range(r.randint(0, 25))), "".join(r.choice('é"\n,') for _ in range(r.randint(0, 9)))])
                if i % 97 == 5:
                    f.write("bad,row\n")
                if i % 97 == 9:
                    f.write('"too","many\nx",c,d\n')
    want = [sorted(map(str, part.collect())) for part in IO.read_csv_parts(spark, folder)]
    for size in (None, 57, 300, 10000):
        assert [sorted(map(str, part.collect())) for part in read_csv_split(spark, folder, split_bytes=size)] == want
    by_name = read_csv_split(spark, folder, ["u", "id"], split_bytes=200)[0]
    assert by_name.columns == ["u", "id"] and by_name.count() == 600
    with pytest.raises(ValueError, match="no column"):
        read_csv_split(spark, folder, ["nothing"])


def test_split_csv_edges(spark):
    folder = scratch_path(spark, "split_edges")
    os.makedirs(folder)
    path = f"{folder}/x.csv"

    def rows(text, **more):
        with open(path, "w", newline="", encoding="utf-8") as f:
            f.write(text)
        return sorted(tuple(r) for r in read_csv_split(spark, path, **more)[0].collect())

    assert rows("a,b\r\n1,\"x\r\ny\"\r\n\r\n2,z\r\n", split_bytes=3) in ([("1", "x\r\ny"), ("2", "z")], [("1", "x\ny"), ("2", "z")])
    assert rows("a,b\n") == [] and rows("﻿a,b\n1,2") == [("1", "2")]
    with pytest.raises(ValueError, match="quoted"):
        rows('a,b\n1,"open\n2,3\n')


def test_small_splits_share_a_task(spark, monkeypatch):
    """Splits may be small without a task, and a file of records, for each."""
    folder, made = scratch_path(spark, "small_splits").replace("file:", ""), {}
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(["id", "t"])
        w.writerows([i, f'line {i}\n"so"\n' * (i % 9) + "long " * (300 * (i % 97 == 1))] for i in range(900))
    monkeypatch.setattr(csv_split, "scratch_path", lambda s, name: made.setdefault(name, scratch_path(s, name)))
    want = [sorted(map(str, part.collect())) for part in IO.read_csv_parts(spark, folder)]
    assert [sorted(map(str, part.collect())) for part in read_csv_split(spark, folder, split_bytes=700)] == want
    records = spark.read.parquet(made["csv_records"])
    assert records.select("__file", "__start").distinct().count() > 80
    tasks = spark.read.text(folder).rdd.getNumPartitions()
    assert len([f for f in os.listdir(made["csv_records"].replace("file:", "")) if f.startswith("part-")]) <= tasks + 1
    assert spark.conf.get(csv_split.MOST_TASKS, None) is None


def test_quoted_csv_is_written_by_all_tasks(spark, monkeypatch):
    """No task writes the rows of the others, and each file has its header."""
    root, seen = scratch_path(spark, "docs"), []
    texts = [None if i % 19 == 0 else 'a "b",\n' * (i % 5) + f"text {i}" * (1 + 900 * (i == 77)) for i in range(400)]
    rows = [(None if i in (3, 300) else i, t, f"l{i % 3}", "s") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4).write.parquet(f"{root}/documents.parquet")
    monkeypatch.setattr(whole_tables, "read_csv_split", lambda s, path, **more: (seen.append(path), read_csv_split(s, path, **more))[1])
    monkeypatch.setattr(whole_tables, "CSV_SPLIT", 700)
    got = whole_tables.csv_quoted_split(spark, root).collect()
    want = [(True, i, None if t is None else t + '\nsaid "so"', f"done {lang}" if i % 3 == 0 else None) for i, t, lang, _ in rows if i is not None]
    # an empty cell and a missing one are the same in the file
    assert sorted((r["row_key"], r["text"] or None, r["output"]) for r in got if r["good"]) == sorted(w[1:] for w in want)
    assert [r["text"] for r in got if not r["good"]] == ['"one cell\nonly"'] * 8
    files = [f for f in os.listdir(seen[0].replace("file:", "")) if f.startswith("part-")]
    assert len(files) == 4
    for f in files:
        with open(f"{seen[0].replace('file:', '')}/{f}", encoding="utf-8") as fh:
            assert fh.read().count("row_key,instruction,output\n") == 1


def test_report_parts_are_packed(spark, monkeypatch):
    sizes = {}

    def spied(lines, root, *more):
        write_reports(lines, root, *more)
        for folder, _, names in os.walk(root.replace("file:", "")):
            sizes.update({f"{folder}/{n}": os.path.getsize(f"{folder}/{n}") for n in names if n.startswith("part-")})

    monkeypatch.setattr(report, "write_reports", spied)
    lines = spark.range(4000).selectExpr("'e' eval_name", "'m' model_name", "1 section", "lpad(id, 20, '0') ord", "'' sub", "concat('<p>line ', id, repeat(' မြန်မာ', 9), '</p>') line")
    (file,) = write_report_files(lines, scratch_path(spark, "packed"), num_partitions=3)
    with open(file.replace("file:", ""), encoding="utf-8") as f:
        text = f.read()
    assert text == "".join(f"<p>line {i}{' မြန်မာ' * 9}</p>\n" for i in range(4000))
    assert len(sizes) == 3 and sum(sizes.values()) * 5 < len(text.encode())


def test_reports_leave_no_shuffle_files(spark, monkeypatch):
    """While parts are joined, the disk holds no shuffled lines, and no part that is joined."""
    shuffled = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")))
    before, left, paths = shuffled(), [], []

    def spied(lines, root, *more):
        write_reports(lines, root, *more)
        left.extend(shuffled() - before)
        paths.append(root.replace("file:", ""))

    monkeypatch.setattr(report, "write_reports", spied)
    rows = spark.range(4000).selectExpr("'e' eval_name", "concat('m', id % 3) model_name", "1 section", "lpad(id, 20, '0') ord", "'' sub", "concat('<p>', id, '</p>') line")
    files = write_report_files(rows, scratch_path(spark, "no_shuffles"), num_partitions=3)
    assert len(files) == 3 and left == [] and not os.path.exists(paths[0])
    assert spark.conf.get(report.SHUFFLES_GO) == "false"


def test_joined_parts_are_deleted_at_once(spark, monkeypatch):
    """A part that cannot be read ends the joining; those before it are gone from the disk."""
    parts = []

    def spied(lines, root, *more):
        write_reports(lines, root, *more)
        parts.extend(sorted(f"{d}/{n}" for d, _, names in os.walk(root.replace("file:", "")) for n in names if n.startswith("part-")))
        os.remove(parts[-1])
        os.mkdir(parts[-1])

    monkeypatch.setattr(report, "write_reports", spied)
    rows = spark.range(4000).selectExpr("'e' eval_name", "'m' model_name", "1 section", "lpad(id, 20, '0') ord", "'' sub", "concat('<p>', id, '</p>') line")
    root = scratch_path(spark, "joined_parts")
    with pytest.raises(Exception):
        write_report_files(rows, root, num_partitions=3)
    assert len(parts) == 3 and [os.path.exists(p) for p in parts] == [False, False, True]
    assert [f for f in os.listdir(root.replace("file:", "")) if f.endswith(".html")] == []


def test_report_files_replace_each_other(spark):
    rows = [("e", "m/1", s, str(i), "", f"line {i}") for s in (0, 1) for i in range(30)] + [("e", "m2", 0, "", "", "only")]
    lines = spark.createDataFrame(rows, "eval_name string, model_name string, section int, ord string, sub string, line string")
    root = scratch_path(spark, "files")
    for _ in range(2):
        files = write_report_files(lines, root, num_partitions=5)
    names = sorted(f for f in os.listdir(root) if not f.startswith((".", "_")))
    assert len(files) == len(names) == 2 and all(n.endswith(".html") for n in names)
    with open(f"{root}/{names[0]}", encoding="utf-8") as f:
        got = f.read().splitlines()
    assert got == [f"line {i}" for _ in (0, 1) for i in sorted(range(30), key=str)]
    assert os.listdir(f"{root}/_parts") == [] or not any("part-" in f for f in os.listdir(f"{root}/_parts"))


def test_ordered_sinks(spark):
    rows = spark.range(400).select((399 - F.col("id")).alias("k")).repartition(4)
    jsonl, table_ = scratch_path(spark, "jsonl"), scratch_path(spark, "csv")
    IO.write_sft_jsonl(rows.select("k", pack_messages(F.col("k").cast("string")).alias("messages")), jsonl, order=["k"])
    IO.write_csv(rows, table_, order=["k"])
    back = with_positions(from_files(spark.read.schema("messages array<struct<role:string,content:string>>").json(jsonl)))
    assert all(r["position"] == int(r["messages"][0]["content"]) for r in back.collect())
    back = with_positions(from_files(spark.read.option("header", "true").csv(table_)))
    assert all(r["position"] == int(r["k"]) for r in back.collect())


def test_variant_of_a_message(spark):
    rows = spark.createDataFrame([("user", "hi", "<2>"), ("user", "hi", None), ("user", "hi", "")], "r string, c string, v string")
    got = [r[0] for r in rows.select(message_html("r", "c", F.col("v"))).collect()]
    assert "&lt;2&gt;" in got[0] and got[1] == got[2] and "small" not in got[1]


def test_variants_reach_the_report(spark):
    from gradeflow.plans.evals import finish_examples

    rows = S.mmlu_items(spark, SF_SMALL).limit(1).select(
        F.expr("array(named_struct('role', 'user', 'content', 'q', 'variant', 'b'))").alias("prompt_messages"), F.lit("r").alias("response_text"), "answer", F.lit("A").alias("extracted"), F.lit(1.0).alias("score")
    )
    assert "<small>b</small>" in finish_examples(rows).first()["html"]
