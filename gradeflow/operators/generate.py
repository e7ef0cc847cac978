"""Instruction data from chat templates: every row meets every template group.

Templates are a small table. Each row is exploded to the group ids only; one template
per (row, group) is picked by a hash of (key, group, seed); the group's variables are
checked in sorted order and the first bad one rejects the pair; accepted pairs are joined
to the one picked template and get every ``{{var}}`` slot filled. The templates come from
the caller's list, so they are the side that is broadcast, whatever Spark guesses the rows'
size to be from the size of their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import SLOT_PATTERN
from ..functions.extract import java_regex
from ..functions.text import as_col
from .sample import pick_index

VAR_NOT_FOUND = "variable not found"
VALUE_NOT_VALID = "value not valid"

# Default template groups: this project's own wording. Each group asks about one
# dictionary field; roles follow the System/User/Chatbot convention.
SYSTEM_TEXT = "You are a careful Burmese dictionary assistant. Answer precisely and briefly."
DEFAULT_TEMPLATE_GROUPS: list[list[list[dict]]] = [
    [  # meaning
        [
            {"role": "System", "content": SYSTEM_TEXT},
            {"role": "User", "content": "What does the word {{word}} mean?"},
            {"role": "Chatbot", "content": "{{word}} means: {{meaning}}."},
        ],
        [
            {"role": "System", "content": SYSTEM_TEXT},
            {"role": "User", "content": "Please define \"{{word}}\"."},
            {"role": "Chatbot", "content": "Definition of \"{{word}}\": {{meaning}}."},
        ],
    ],
    [  # reverse lookup
        [
            {"role": "System", "content": SYSTEM_TEXT},
            {"role": "User", "content": "Which word means {{meaning}}?"},
            {"role": "Chatbot", "content": "The word is {{word}}."},
        ],
        [
            {"role": "System", "content": SYSTEM_TEXT},
            {"role": "User", "content": "Give me the Burmese word for: {{meaning}}"},
            {"role": "Chatbot", "content": "That is \"{{word}}\"."},
        ],
    ],
    [  # pronunciation
        [
            {"role": "System", "content": SYSTEM_TEXT},
            {"role": "User", "content": "How is {{word}} pronounced?"},
            {"role": "Chatbot", "content": "{{word}} is pronounced {{phonetics}}."},
        ],
        [
            {"role": "System", "content": SYSTEM_TEXT},
            {"role": "User", "content": "Spell out the sound of \"{{word}}\"."},
            {"role": "Chatbot", "content": "It sounds like {{phonetics}}."},
        ],
    ],
    [  # origin
        [
            {"role": "System", "content": SYSTEM_TEXT},
            {"role": "User", "content": "Where does the word {{word}} come from?"},
            {"role": "Chatbot", "content": "{{word}} comes from {{origin}}."},
        ],
        [
            {"role": "System", "content": SYSTEM_TEXT},
            {"role": "User", "content": "What is the origin of \"{{word}}\"?"},
            {"role": "Chatbot", "content": "Its origin is {{origin}}."},
        ],
    ],
    [  # part of speech
        [
            {"role": "System", "content": SYSTEM_TEXT},
            {"role": "User", "content": "Which part of speech is {{word}}?"},
            {"role": "Chatbot", "content": "{{word}} is a {{pos}}."},
        ],
        [
            {"role": "System", "content": SYSTEM_TEXT},
            {"role": "User", "content": "Classify \"{{word}}\" grammatically."},
            {"role": "Chatbot", "content": "\"{{word}}\" is used as a {{pos}}."},
        ],
    ],
]

# Java reads a bare brace as a repetition.
SLOTS = java_regex(SLOT_PATTERN.replace("{", r"\{").replace("}", r"\}"))


def template_table(spark: SparkSession, groups: Sequence[Sequence[Sequence[dict]]]) -> DataFrame:
    """(group_id, template_id, messages): all message keys are kept, as text fields."""
    extra = sorted({k for g in groups for t in g for m in t for k in m} - {"role", "content"})
    fields = ["role", "content", *extra]
    text = lambda v: v if v is None or isinstance(v, str) else str(v)
    rows = [(gid, tid, [tuple(text(m.get(k)) for k in fields) for m in t]) for gid, group in enumerate(groups) for tid, t in enumerate(group)]
    message = ",".join(f"`{f}`:string" for f in fields)
    return spark.createDataFrame(rows, f"group_id int, template_id int, messages array<struct<{message}>>")


def slots(text) -> Column:
    """All ``{{name}}`` slot names of a text, in order (repeats kept)."""
    return F.regexp_extract_all(F.coalesce(as_col(text), F.lit("")), F.lit(SLOTS), 1)


def corpus_variables(df: DataFrame, text_col: str, group_col: str) -> DataFrame:
    """(group, name, n_texts): in how many texts of a group each slot name occurs.

    One row per name, counted map-side first: neither a hot group nor a large slot
    vocabulary meets in one row.
    """
    names = df.select(group_col, F.explode(F.array_distinct(slots(text_col))).alias("name"))
    return names.groupBy(group_col, "name").agg(F.count(F.lit(1)).alias("n_texts"))


def template_variables(templates: DataFrame) -> DataFrame:
    """(group_id, n_templates, vars): the templates of a group and its sorted slot names."""
    found = F.array_distinct(F.flatten(F.transform("messages", lambda m: slots(m["content"]))))
    names = templates.select("group_id", "template_id", F.explode_outer(found).alias("name"))
    return names.groupBy("group_id").agg(F.countDistinct("template_id").alias("n_templates"), F.array_sort(F.collect_set("name")).alias("vars"))


def fill_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text of each column with null as '' (the dictionary clean-up step)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns if c in df.columns})


def _value(df: DataFrame, name: str) -> Column:
    """Column value as text; null, '', NaN and numeric zero count as missing."""
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when((c != 0) & ~F.isnan(c), c.cast("string"))
    if isinstance(kind, T.NumericType):
        return F.when(c != 0, c.cast("string"))
    if isinstance(kind, T.BooleanType):
        return F.when(c, F.lit("True"))
    return F.when(c.cast("string") != "", c.cast("string"))


def expand(df: DataFrame, groups, key_col: str = "row_key", seed: int = 0) -> DataFrame:
    """One row per (row, group) with the id of the picked template, filled messages and
    the first bad variable (null when the pair is accepted)."""
    templates = template_table(df.sparkSession, groups)
    info = template_variables(templates)
    # The names that templates use, from the caller's own (driver-side) templates.
    used = [r[0] for r in info.select(F.explode("vars").alias("v")).distinct().orderBy("v").collect()]
    present = [v for v in used if v in df.columns]
    values = F.create_map(*[x for v in present for x in (F.lit(v), _value(df, v))]) if present else F.create_map().cast("map<string,string>")
    ids = [F.lit(i) for i, g in enumerate(groups) if g]
    each = F.explode(F.array(*ids) if ids else F.array().cast("array<int>"))
    rows = df.select(F.col(key_col).alias("row_key"), values.alias("_vals"), each.alias("group_id")).join(F.broadcast(info), "group_id")
    vals = F.col("_vals")
    bad = F.get(F.filter("vars", lambda v: ~F.map_contains_key(vals, v) | vals[v].isNull()), 0)
    pick = pick_index([F.col("row_key"), F.col("group_id")], F.col("n_templates"), seed)
    pairs = rows.select("row_key", "group_id", pick.alias("template_id"), bad.alias("bad_variable"), "vars", "_vals")
    reason = F.when(F.col("bad_variable").isNotNull(), F.when(F.map_contains_key(vals, F.col("bad_variable")), VALUE_NOT_VALID).otherwise(VAR_NOT_FOUND))
    filled = F.transform("messages", lambda m: m.withField("content", _filled(m["content"], F.col("vars"), vals)))
    return pairs.join(F.broadcast(templates), ["group_id", "template_id"]).select(
        "row_key", "group_id", "template_id", "bad_variable", reason.alias("reason"), F.when(F.col("bad_variable").isNull(), filled).alias("messages")
    )


def _filled(content: Column, names: Column, vals: Column) -> Column:
    return F.aggregate(names, content, lambda text, v: F.replace(text, F.concat(F.lit("{{"), v, F.lit("}}")), F.coalesce(vals[v], F.lit(""))))


def generate(df: DataFrame, groups=None, key_col: str = "row_key", seed: int = 0, materialize_pairs: bool = False) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): SFT records ``(row_key, group_id, template_id, messages)``
    and rejections ``(row_key, group_id, variable, reason)``.

    Without ``groups`` the default templates are used; an empty list gives empty results.
    Both outputs come from one expansion; with ``materialize_pairs`` it is written once
    to the checkpoint folder, so using both outputs does not expand twice.
    """
    pairs = expand(df, DEFAULT_TEMPLATE_GROUPS if groups is None else groups, key_col, seed)
    if materialize_pairs:
        from ..sources.io import materialize

        pairs = materialize(pairs, "template_pairs")
    accepted = pairs.filter(F.col("bad_variable").isNull()).select("row_key", "group_id", "template_id", "messages")
    rejected = pairs.filter(F.col("bad_variable").isNotNull()).select(
        "row_key", "group_id", F.col("bad_variable").alias("variable"), "reason"
    )
    return accepted, rejected


def reject_counts(rejected: DataFrame) -> DataFrame:
    """(reason, variable, n) of a reject log."""
    return rejected.groupBy("reason", "variable").agg(F.count(F.lit(1)).alias("n"))
