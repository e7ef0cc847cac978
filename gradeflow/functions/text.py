"""Scalar text functions as Catalyst expressions (no Python in the row path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import (
    JUDGE_YES,
    OPTION_LABELS,
    OPTION_LETTERS,
    PY_WHITESPACE_CLASS,
    RESPONSE_REMOVALS,
)


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_str(c) -> Column:
    """Text of a value as Python's ``str()`` shows it in a prompt; null -> 'None'."""
    return F.coalesce(as_col(c).cast("string"), F.lit("None"))


def py_strip(c) -> Column:
    """``str.strip()``: removes Unicode white space and U+001C..U+001F at both ends."""
    ws = PY_WHITESPACE_CLASS
    return F.regexp_replace(as_col(c), f"^{ws}+|{ws}+\\z", "")


def is_blank(c) -> Column:
    """Null, or empty after ``str.strip()``."""
    c = as_col(c)
    return c.isNull() | (py_strip(c.cast("string")) == F.lit(""))


def remove_literals(c, literals) -> Column:
    out = as_col(c)
    for s in literals:
        out = F.replace(out, F.lit(s), F.lit(""))
    return out


def normalize_response(c) -> Column:
    """Drop markdown bold and LaTeX wrappers, literally and in a fixed order."""
    return remove_literals(c, RESPONSE_REMOVALS)


def normalize_extracted_answer(c) -> Column:
    """Map Burmese option labels to ' A'..' D' everywhere, then strip."""
    out = as_col(c)
    for label, letter in zip(OPTION_LABELS, OPTION_LETTERS):
        out = F.replace(out, F.lit(label), F.lit(" " + letter))
    return py_strip(out)


def judge_verdict(c) -> Column:
    """True when the judge's reply is 'yes' after strip and lower-casing."""
    return F.lower(py_strip(c)) == F.lit(JUDGE_YES)


def html_escape(c) -> Column:
    out = as_col(c)
    for src, dst in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("'", "&#39;"), ('"', "&#34;")):
        out = F.replace(out, F.lit(src), F.lit(dst))
    return out


def message_html(role, content, variant=None) -> Column:
    """One chat message as an HTML block; every field is escaped. A variant (which of several
    messages of one turn this is) is shown after the role where there is one."""
    role = html_escape(py_str(role))
    shown = F.lit("")
    if variant is not None:
        v = as_col(variant).cast("string")
        shown = F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(" <small>"), html_escape(v), F.lit("</small>"))).otherwise(F.lit(""))
    text = html_escape(F.coalesce(as_col(content).cast("string"), F.lit("None")))
    return F.concat(F.lit('<section data-from="'), role, F.lit('"><h3>'), role, shown, F.lit("</h3><pre>"), text, F.lit("</pre></section>"))


def score_display(c) -> Column:
    """``score | float | round(3)``: a missing score shows as 0.0."""
    return F.round(F.coalesce(as_col(c).cast("double"), F.lit(0.0)), 3)
