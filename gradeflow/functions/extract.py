"""Answer extraction (regex search, leftmost match, first pattern that matches).

Patterns are kept in Python ``re`` spelling (see ``fixed_values``) and turned
into Java patterns with flags ``iUd``: ``U`` gives Unicode ``\\d`` and case
folding, ``d`` makes ``.`` and ``$`` treat only ``\\n`` as a line end, as
Python does; ``\\s`` becomes the explicit Python white-space class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import (
    ANSWER_HEAD,
    ENGLISH_FREE_PATTERN,
    ENGLISH_MCQ_PATTERN,
    FIB_TAIL,
    MCQ_TAIL,
    OPTION_LABELS,
    OPTION_LETTERS,
    PY_WHITESPACE_CLASS,
    TOF_TAIL,
)
from .text import as_col, normalize_extracted_answer

JAVA_FLAGS = "(?iUd)"


def java_regex(py_pattern: str, flags: str = JAVA_FLAGS) -> str:
    """Python-``re`` pattern -> Java pattern with the same meaning on text."""
    return flags + py_pattern.replace("\\s", PY_WHITESPACE_CLASS)


def first_match(text, patterns: Sequence[str], group: int = 1, nonempty_group: bool = False) -> Column:
    """Group of the leftmost match of the first pattern that matches, else null.

    ``regexp_extract`` returns '' on no match. When the group can be empty on a
    real match, each try is guarded with ``rlike`` (two scans); when it cannot
    (``nonempty_group``), '' means no match and one scan suffices.
    """
    text = as_col(text)
    if nonempty_group:
        tries = [F.nullif(F.regexp_extract(text, p, group), F.lit("")) for p in patterns]
    else:
        tries = [F.when(text.rlike(p), F.regexp_extract(text, p, group)) for p in patterns]
    return tries[0] if len(tries) == 1 else F.coalesce(*tries)


def quote_literal(c) -> Column:
    """Column text quoted for a Java regex (``\\Q..\\E``, with ``\\E`` escaped)."""
    return F.concat(F.lit("\\Q"), F.replace(as_col(c), F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def extract_mcq_raw(text, heads: Sequence[str] = (ANSWER_HEAD,)) -> Column:
    return first_match(text, [java_regex(h + MCQ_TAIL) for h in heads], nonempty_group=True)


def extract_mcq(text, heads: Sequence[str] = (ANSWER_HEAD,)) -> Column:
    """4-option answer letter (A-D) or null; used by the MMLU evaluation."""
    return normalize_extracted_answer(extract_mcq_raw(text, heads))


def _mcq_prefix(head: str) -> str:
    tail = MCQ_TAIL[: MCQ_TAIL.index("[ဃ])") + len("[ဃ]")]
    return java_regex(head + tail) + "|"


MCQ_SUFFIX = ")(?:\\))?"


def exam_mcq_pattern(answer, head: str = ANSWER_HEAD) -> Column:
    """Per-row pattern: option labels or the row's own answer (quoted literal).

    Python's ``str.format`` writes a missing answer as ``None``.
    """
    return F.concat(F.lit(_mcq_prefix(head)), quote_literal(F.coalesce(as_col(answer), F.lit("None"))), F.lit(MCQ_SUFFIX))


def _quote_text(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def extract_with_pattern(text, pattern, nonempty_group: Column) -> Column:
    """Group 1 of the leftmost match of a per-row pattern column, else null. Where the
    group cannot be empty, '' means no match and one scan is enough."""
    text, pattern = as_col(text), as_col(pattern)
    group = F.call_function("regexp_extract", text, pattern, F.lit(1))
    return F.when(nonempty_group, F.nullif(group, F.lit(""))).when(F.call_function("rlike", text, pattern), group)


#: Answers that are compared as text: printable ASCII and Myanmar letters (which have no case),
#: not beginning with what may stand before an answer.
PLAIN_ANSWER = "^(?![ (])[\\x20-\\x7E\\u1000-\\u109F]+$"
#: Letters beyond ASCII that Python's case folding takes for ASCII ones, and these.
FOLDED_TO_ASCII = ("\u017f\u212a\u0130\u0131", "skii")


def _folded(c) -> Column:
    return F.lower(F.translate(as_col(c), *FOLDED_TO_ASCII))


def literal_answer(text, answer, head: str = ANSWER_HEAD) -> Column:
    """As the pattern of ``exam_mcq_pattern`` finds it, for a plain answer, without a pattern
    per row: the marker's places are found by one constant pattern, and behind each, in
    turn, an option label or the answer is looked for by comparing text."""
    text, answer = as_col(text), as_col(answer)
    mark, gap = head.split(":", 1)
    mark = F.lit(java_regex(mark + ":"))
    between = F.split(text, java_regex(head.split(":", 1)[0] + ":"), -1)
    marks = F.call_function("regexp_extract_all", text, mark, F.lit(0))
    sizes = F.zip_with(F.slice(between, 1, F.size(marks)), marks, lambda a, m: F.length(a) + F.length(m))
    # where the text goes on behind each marker
    ends = F.transform(F.sequence(F.lit(1), F.size(marks)), lambda i: F.aggregate(F.slice(sizes, F.lit(1), i), F.lit(0), lambda x, n: x + n))
    behind = F.when(F.size(marks) > 0, F.transform(ends, lambda end: F.substr(text, end + 1)))
    before = java_regex("^" + gap + "[ \\t]*(?:\\()?")
    rest = F.transform(behind, lambda t: F.substr(t, F.length(F.regexp_extract(t, before, 0)) + 1))
    label = f"^[{OPTION_LABELS[0]}-{OPTION_LABELS[-1]}]"
    given = F.transform(
        rest,
        lambda t: F.when(t.rlike(label), F.substr(t, F.lit(1), F.lit(1))).when(F.startswith(_folded(t), _folded(answer)), F.substr(t, F.lit(1), F.length(answer))),
    )
    return F.get(F.filter(given, lambda g: g.isNotNull()), F.lit(0))


def extract_exam_mcq_raw(text, answer, head: str = ANSWER_HEAD, common_answers=OPTION_LETTERS) -> Column:
    """Raw group of the exam MCQ pattern.

    Rows whose answer is one of ``common_answers`` (or missing) use a constant
    pattern, compiled once per task; any other plain answer is compared as text behind
    the markers that one constant pattern finds. Only answers that are empty, begin with
    a space, a bracket or a newline or hold other letters use a pattern per row
    (Spark recompiles a column pattern whenever it changes between rows).
    """
    text, answer = as_col(text), as_col(answer)
    prefix = _mcq_prefix(head)
    expr = F.when(answer.isNull(), first_match(text, [prefix + _quote_text("None") + MCQ_SUFFIX], nonempty_group=True))
    for a in common_answers:
        if a:
            expr = expr.when(answer == a, first_match(text, [prefix + _quote_text(a) + MCQ_SUFFIX], nonempty_group=True))
    expr = expr.when(answer.rlike(PLAIN_ANSWER), literal_answer(text, answer, head))
    return expr.otherwise(extract_with_pattern(text, exam_mcq_pattern(answer, head), answer != ""))


def normalize_if_nonempty(raw) -> Column:
    raw = as_col(raw)
    return F.when(raw != F.lit(""), normalize_extracted_answer(raw)).otherwise(raw)


def extract_exam_mcq(text, answer, head: str = ANSWER_HEAD) -> Column:
    """Option label, or the row's own answer text, after the marker; then A-D."""
    return normalize_if_nonempty(extract_exam_mcq_raw(text, answer, head))


def extract_tof(text, head: str = ANSWER_HEAD) -> Column:
    return first_match(text, [java_regex(head + TOF_TAIL)], nonempty_group=True)


def extract_fib(text, head: str = ANSWER_HEAD) -> Column:
    """Fill-in answer running to the end of the text; may be ''."""
    return first_match(text, [java_regex(head + FIB_TAIL)])


def extract_open() -> Column:
    """LONG_QNA / METAPHOR_QNA: the marker pattern has no group, so nothing is extracted."""
    return F.lit(None).cast("string")


def extract_english_mcq(text) -> Column:
    return first_match(text, [java_regex(ENGLISH_MCQ_PATTERN)], nonempty_group=True)


def extract_english_free(text) -> Column:
    return first_match(text, [java_regex(ENGLISH_FREE_PATTERN)], nonempty_group=True)
