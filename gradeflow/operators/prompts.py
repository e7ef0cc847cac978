"""Prompt and message construction as column expressions.

The instruction wording here is this project's own default; pass your own
text to any builder.  Only the answer-line convention ('အဖြေ: X') and the
option labels are fixed, since extraction depends on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import FALSE_WORD, OPTION_LABELS, RUBRIC, TRUE_WORD, UNKNOWN_TYPE_MESSAGE
from ..functions.text import as_col, is_blank, py_str

MCQ_INSTRUCTION = (
    "Read the question and pick the right option. Reason step by step first. "
    "Finish with one line 'အဖြေ: X', where X is one of {labels}."
)
TOF_INSTRUCTION = (
    f"Decide whether the statement below is true ({TRUE_WORD}) or false ({FALSE_WORD}). "
    f"Reason step by step first, then finish with one line 'အဖြေ: {TRUE_WORD}' or 'အဖြေ: {FALSE_WORD}'."
)
FIB_INSTRUCTION = (
    "Fill in the blank in the sentence below with the best word. Reason step by step first, "
    "then finish with one line 'အဖြေ: WORD'."
)
OPEN_INSTRUCTION = "Answer the question below, reasoning step by step."
GRADER_INSTRUCTION = (
    "You grade answers written in Burmese. Compare the model response with the expected answer "
    "for the question, justify each score in one sentence, and end with the three score lines."
)
JUDGE_INSTRUCTION = (
    "Do the two expressions below state the same answer? Allow only trivial rewriting "
    "(order of terms, equivalent fractions, units left out). Reply with Yes or No only."
)
ALPACA_WITH_INPUT = (
    "Below is an instruction that describes a task, paired with an input that provides further "
    "context. Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:"
)
ALPACA_NO_INPUT = (
    "Below is an instruction that describes a task. Write a response that appropriately "
    "completes the request.\n\n### Instruction:\n{instruction}\n\n### Response:"
)


def fill(template: str, **values) -> Column:
    """Single-pass ``str.format``: slot text inside a value is never expanded again."""
    parts: list[Column] = []
    rest = template
    while rest:
        start = rest.find("{")
        if start < 0:
            parts.append(F.lit(rest))
            break
        end = rest.index("}", start)
        if start:
            parts.append(F.lit(rest[:start]))
        parts.append(values[rest[start + 1 : end]])
        rest = rest[end + 1 :]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def options_block(options: Sequence, labels: Sequence[str] = OPTION_LABELS) -> Column:
    if len(options) > len(labels):
        raise ValueError(f"{len(options)} options, but only {len(labels)} labels")
    lines: list[Column] = []
    for i, (label, opt) in enumerate(zip(labels, options)):
        lines.append(F.lit(("\n" if i else "") + f"({label}) "))
        lines.append(py_str(opt))
    return F.concat(*lines)


def mcq_prompt(question, options: Sequence, instruction: str = MCQ_INSTRUCTION, labels: Sequence[str] = OPTION_LABELS) -> Column:
    """Instruction, question and labelled options in one user prompt, a label for each."""
    if len(options) > len(labels):
        raise ValueError(f"{len(options)} options, but only {len(labels)} labels")
    labels = list(labels)[: len(options)]
    head = instruction.format(labels=", ".join(labels))
    return F.concat(F.lit(head + "\n\n"), py_str(question), F.lit("\n\n"), options_block(options, labels))


def typed_prompt(qtype, question, option_a, option_b, option_c) -> Column:
    """Prompt by exam question type; an unknown type fails the query with its name."""
    t = as_col(qtype)
    q = py_str(question)
    return (
        F.when(t == "MCQ", mcq_prompt(question, [option_a, option_b, option_c]))
        .when(t == "TOF", F.concat(F.lit(TOF_INSTRUCTION + "\n\n"), q))
        .when(t == "FIB", F.concat(F.lit(FIB_INSTRUCTION + "\n\n"), q))
        .when(t.isin("SHORT_QNA", "LONG_QNA", "METAPHOR_QNA"), F.concat(F.lit(OPEN_INSTRUCTION + "\n\n"), q))
        .otherwise(F.raise_error(F.concat(F.lit(UNKNOWN_TYPE_MESSAGE), py_str(t))).cast("string"))
    )


def filter_types(df: DataFrame, types: Sequence[str] | None, type_col: str = "type") -> DataFrame:
    """Keep rows of the listed types; no list (or an empty one) keeps all."""
    return df.filter(F.col(type_col).isin(list(types))) if types else df


def alpaca_prompt(df: DataFrame, with_input: str = ALPACA_WITH_INPUT, no_input: str = ALPACA_NO_INPUT) -> Column:
    """Alpaca prompt; the input form is used when ``input`` is non-blank. Missing
    columns and nulls count as ''."""
    cols = set(df.columns)
    instruction = F.coalesce(F.col("instruction").cast("string"), F.lit("")) if "instruction" in cols else F.lit("")
    inp = F.coalesce(F.col("input").cast("string"), F.lit("")) if "input" in cols else F.lit("")
    return F.when(~is_blank(inp), fill(with_input, instruction=instruction, input=inp)).otherwise(
        fill(no_input, instruction=instruction)
    )


def simple_prompt(df: DataFrame) -> Column:
    """The ``input`` column if the table has one, else ``prompt``, else ''. The choice
    is made once for the column, not per row; null counts as ''."""
    for name in ("input", "prompt"):
        if name in df.columns:
            return F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.lit("")


def message(role, content) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.cast("string").alias("role"), as_col(content).cast("string").alias("content"))


def pack_messages(content, role: str = "user", system: str | Column | None = None) -> Column:
    """``[{role, content}]``, with an optional system message first."""
    msgs = F.array(message(role, content))
    if system is not None:
        sys_msg = F.array(message("system", F.lit(system) if isinstance(system, str) else system))
        msgs = F.concat(sys_msg, msgs)
    return msgs


def text_part(text) -> Column:
    return F.struct(F.lit("text").alias("type"), as_col(text).alias("text"), F.lit(None).cast("string").alias("image_url"))


def image_part(image, encoding: str = "base64", fmt: str = "png") -> Column:
    """Image part as a data URI; binary input is base64-encoded first."""
    img = as_col(image)
    return F.struct(
        F.lit("image_url").alias("type"),
        F.lit(None).cast("string").alias("text"),
        F.concat(F.lit(f"data:image/{fmt};{encoding},"), img).alias("image_url"),
    )


def image_part_from_binary(binary, fmt: str = "png") -> Column:
    """Base64 without the MIME line breaks Spark's ``base64`` may insert."""
    return image_part(F.regexp_replace(F.base64(as_col(binary)), "[\\r\\n]", ""), "base64", fmt)


def grader_prompt(question, target, predicted) -> Column:
    """Rubric prompt; asks for the three fixed ``Name: <n>`` lines."""
    scale = "\n".join(f"{name}: <{lo}-{hi}>" for name, lo, hi in RUBRIC)
    return F.concat(
        F.lit(GRADER_INSTRUCTION + "\n\nQuestion:\n"), py_str(question),
        F.lit("\n\nExpected answer:\n"), py_str(target),
        F.lit("\n\nModel response:\n"), py_str(predicted),
        F.lit("\n\nEnd with exactly these lines:\n" + scale + "\n"),
    )


def judge_prompt(expr1, expr2) -> Column:
    return F.concat(
        F.lit(JUDGE_INSTRUCTION + "\n\nExpression 1: "), py_str(expr1), F.lit("\nExpression 2: "), py_str(expr2)
    )


def conversation(messages, response) -> Column:
    """Prompt messages followed by the assistant's (normalised) reply."""
    return F.concat(as_col(messages), F.array(message("assistant", response)))
