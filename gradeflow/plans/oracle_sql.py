"""DuckDB SQL for the registered queries (the correctness oracle).

The stand-in tables and every operator are restated in SQL; patterns reuse
the fixed values, translated to RE2 (``(?i)``, explicit white space, Python's
``$`` as ``\\n?$``).
"""

from __future__ import annotations

from ..fixed_values import (
    ANSWER_HEAD,
    BAD_REQUEST_TEXT,
    ENGLISH_FREE_PATTERN,
    ENGLISH_MCQ_PATTERN,
    NA_STRINGS,
    RUBRIC,
    SUBJECT_CATEGORY,
    FIB_TAIL,
    MCQ_TAIL,
    OPTION_LABELS,
    OPTION_LETTERS,
    PY_WHITESPACE_CLASS,
    RESPONSE_REMOVALS,
    TOF_TAIL,
)

from ..operators import prompts as P
from ..operators.generate import DEFAULT_TEMPLATE_GROUPS
from ..operators.report import REPORT_HEAD, REPORT_TAIL

WS = PY_WHITESPACE_CLASS
SYSTEM_MESSAGE = "You are a helpful assistant."


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def re2(py_pattern: str) -> str:
    p = py_pattern.replace("\\s", WS)
    if p.endswith("$"):
        p = p[:-1] + "\\n?$"
    return "(?i)" + p


def replace_all(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, {lit(a)}, {lit(b)})"
    return x


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, {lit('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def normalize_response(x: str) -> str:
    return replace_all(x, [(s, "") for s in RESPONSE_REMOVALS])


def normalize_extracted(x: str) -> str:
    return py_strip(replace_all(x, [(a, " " + b) for a, b in zip(OPTION_LABELS, OPTION_LETTERS)]))


def first_match(x: str, py_pattern: str) -> str:
    p = lit(re2(py_pattern))
    return f"(CASE WHEN regexp_matches({x}, {p}) THEN regexp_extract({x}, {p}, 1) END)"


def exam_mcq(x: str, answer: str) -> str:
    tail = MCQ_TAIL[: MCQ_TAIL.index("[ဃ])") + len("[ဃ]")]
    quoted = f"'\\Q' || replace(coalesce({answer}, 'None'), '\\E', '\\E\\\\E\\Q') || '\\E'"
    pat = f"({lit(re2(ANSWER_HEAD + tail) + '|')} || {quoted} || ')(?:\\))?')"
    raw = f"(CASE WHEN regexp_matches({x}, {pat}) THEN regexp_extract({x}, {pat}, 1) END)"
    return f"(CASE WHEN {raw} <> '' THEN {normalize_extracted(raw)} ELSE {raw} END)"


def tof(x: str) -> str:
    return first_match(x, ANSWER_HEAD + TOF_TAIL)


def fib(x: str) -> str:
    return first_match(x, ANSWER_HEAD + FIB_TAIL)


def mcq4(x: str) -> str:
    return normalize_extracted(first_match(x, ANSWER_HEAD + MCQ_TAIL))


def by_type(t: str, x: str, answer: str) -> str:
    return (
        f"(CASE {t} WHEN 'MCQ' THEN {exam_mcq(x, answer)} WHEN 'TOF' THEN {tof(x)} "
        f"WHEN 'FIB' THEN {fib(x)} ELSE NULL END)"
    )


def exact(extracted: str, answer: str) -> str:
    return f"(CASE WHEN {extracted} IS NOT DISTINCT FROM {answer} THEN 1.0 ELSE 0.0 END)::DOUBLE"


# --- stand-in tables -------------------------------------------------------

EXAM_ITEMS = """exam_items AS (
  SELECT p_partkey AS item_id,
    CASE p_partkey % 6 WHEN 0 THEN 'MCQ' WHEN 1 THEN 'TOF' WHEN 2 THEN 'FIB'
      WHEN 3 THEN 'SHORT_QNA' WHEN 4 THEN 'LONG_QNA' ELSE 'METAPHOR_QNA' END AS type,
    p_name AS question, p_brand AS option_a, p_type AS option_b,
    CAST(p_size AS VARCHAR) AS option_c,
    CASE WHEN p_partkey % 50 = 49 THEN NULL
      WHEN p_partkey % 6 = 0 THEN substr('ABC', CAST(1 + p_partkey % 7 % 3 AS INTEGER), 1)
      WHEN p_partkey % 6 = 1 THEN CASE WHEN p_partkey % 4 = 1 THEN 'မှန်' ELSE 'မှား' END
      ELSE p_brand END AS answer
  FROM part)"""

MMLU_ITEMS = """mmlu_items AS (
  SELECT p_partkey AS item_id,
    CASE WHEN p_partkey % 11 = 10 THEN NULL ELSE
      (CASE p_partkey % 5 WHEN 0 THEN 'astronomy' WHEN 1 THEN 'philosophy' WHEN 2 THEN 'sociology'
        WHEN 3 THEN 'virology' ELSE 'unknown_subject' END) || '/test/' || CAST(p_partkey AS VARCHAR) END AS sample_id,
    p_name AS question, p_brand AS option_a, p_type AS option_b,
    CAST(p_size AS VARCHAR) AS option_c, p_name AS option_d,
    substr('ABCD', CAST(1 + p_partkey % 4 AS INTEGER), 1) AS answer
  FROM part)"""

MODEL_RESPONSES = """model_responses AS (
  SELECT l_orderkey, l_linenumber, 'm' || CAST(l_suppkey % 4 AS VARCHAR) AS model_name,
    l_partkey AS item_id,
    CASE WHEN l_linenumber % 5 = 4 THEN 'no marker here'
      WHEN l_partkey % 6 = 0 THEN '**အဖြေ: (' || substr('ကခဂဃ', CAST(1 + CAST(trunc(l_quantity) AS BIGINT) % 4 AS INTEGER), 1) || ')**'
      WHEN l_partkey % 6 = 1 THEN CASE WHEN CAST(trunc(l_quantity) AS BIGINT) % 2 = 0 THEN '$အဖြေ : မှန်$' ELSE '$အဖြေ : မှား$' END
      ELSE 'step' || chr(10) || 'အဖြေ: (Brand#' || CAST(CAST(trunc(l_quantity) AS BIGINT) % 5 AS VARCHAR) || ')'
    END AS response
  FROM lineitem)"""


def stats_long(src: str, group: str, eval_name: str) -> str:
    """mean -> metric, std -> metric:std, from a (group, metric, value) relation."""
    return f"""agg AS (
  SELECT {group}, metric, avg(value) AS m, stddev_pop(value) AS s FROM {src} GROUP BY {group}, metric)
SELECT '{eval_name}' AS eval_name, {group}, metric, round(m, 9) AS value FROM agg
UNION ALL
SELECT '{eval_name}' AS eval_name, {group}, metric || ':std' AS metric, round(s, 9) AS value FROM agg"""


def exam_scored(types: list[str]) -> str:
    type_list = ", ".join(lit(t) for t in types)
    resp = normalize_response("r.response")
    return f"""{EXAM_ITEMS},
{MODEL_RESPONSES},
joined AS (
  SELECT r.l_orderkey, r.l_linenumber, r.model_name, r.item_id, i.type, i.answer, {resp} AS response_text
  FROM model_responses r JOIN exam_items i ON r.item_id = i.item_id
  WHERE i.type IN ({type_list})),
extracted AS (
  SELECT *, {by_type('type', 'response_text', 'answer')} AS extracted FROM joined),
scored AS (
  SELECT *, {exact('extracted', 'answer')} AS score FROM extracted)"""


def eval_scorecard() -> str:
    return f"""WITH {exam_scored(['MCQ', 'FIB', 'TOF'])},
long AS (
  SELECT model_name, type AS metric, score AS value FROM scored
  UNION ALL SELECT model_name, 'score' AS metric, score AS value FROM scored),
{stats_long('long', 'model_name', 'mg12l')}"""



# --- more expressions ----------------------------------------------------------

def py_str(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'None')"


def is_blank(x: str) -> str:
    return f"({x} IS NULL OR {py_strip(x)} = '')"


def html_escape(x: str) -> str:
    return replace_all(x, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("'", "&#39;"), ('"', "&#34;")])


def message_html(role: str, content: str, variant: str = "NULL") -> str:
    r = html_escape(py_str(role))
    v = f"CASE WHEN coalesce({variant}, '') <> '' THEN ' <small>' || {html_escape(variant)} || '</small>' ELSE '' END"
    shown = "" if variant == "NULL" else f" || {v}"
    return f"""('<section data-from="' || {r} || '"><h3>' || {r}{shown} || '</h3><pre>' || {html_escape(py_str(content))} || '</pre></section>')"""


def concat(*parts: str) -> str:
    return "(" + " || ".join(parts) + ")"


def mcq_prompt(question: str, options: list[str]) -> str:
    labels = OPTION_LABELS[: len(options)]
    head = P.MCQ_INSTRUCTION.format(labels=", ".join(labels))
    parts = [lit(head + "\n\n"), py_str(question), lit("\n\n")]
    for i, (label, opt) in enumerate(zip(labels, options)):
        parts += [lit(("\n" if i else "") + f"({label}) "), py_str(opt)]
    return concat(*parts)


def typed_prompt(t: str, q: str, a: str, b: str, c: str) -> str:
    return (
        f"(CASE WHEN {t} = 'MCQ' THEN {mcq_prompt(q, [a, b, c])} "
        f"WHEN {t} = 'TOF' THEN {concat(lit(P.TOF_INSTRUCTION + chr(10) * 2), py_str(q))} "
        f"WHEN {t} = 'FIB' THEN {concat(lit(P.FIB_INSTRUCTION + chr(10) * 2), py_str(q))} "
        f"WHEN {t} IN ('SHORT_QNA', 'LONG_QNA', 'METAPHOR_QNA') THEN {concat(lit(P.OPEN_INSTRUCTION + chr(10) * 2), py_str(q))} END)"
    )


def grader_prompt(q: str, target: str, predicted: str) -> str:
    scale = "\n".join(f"{name}: <{lo}-{hi}>" for name, lo, hi in RUBRIC)
    return concat(
        lit(P.GRADER_INSTRUCTION + "\n\nQuestion:\n"), py_str(q),
        lit("\n\nExpected answer:\n"), py_str(target),
        lit("\n\nModel response:\n"), py_str(predicted),
        lit("\n\nEnd with exactly these lines:\n" + scale + "\n"),
    )


def judge_prompt(e1: str, e2: str) -> str:
    return concat(lit(P.JUDGE_INSTRUCTION + "\n\nExpression 1: "), py_str(e1), lit("\nExpression 2: "), py_str(e2))


def fill(template: str, **values: str) -> str:
    parts, rest = [], template
    while rest:
        start = rest.find("{")
        if start < 0:
            parts.append(lit(rest))
            break
        end = rest.index("}", start)
        if start:
            parts.append(lit(rest[:start]))
        parts.append(values[rest[start + 1 : end]])
        rest = rest[end + 1 :]
    return concat(*parts)


def alpaca(instruction: str, inp: str) -> str:
    i, x = f"coalesce({instruction}, '')", f"coalesce({inp}, '')"
    return (
        f"(CASE WHEN NOT {is_blank(x)} THEN {fill(P.ALPACA_WITH_INPUT, instruction=i, input=x)} "
        f"ELSE {fill(P.ALPACA_NO_INPUT, instruction=i)} END)"
    )


def example_html(prompt: str, response: str, answer: str, extracted: str, score: str) -> str:
    return concat(
        lit("<article><h2>Asked</h2>"),
        message_html("'user'", prompt),
        lit("<h2>Replied</h2>"),
        message_html("'assistant'", response),
        lit('<dl class="result"><dt>score</dt><dd>'), html_escape(py_str(score)),
        lit("</dd><dt>expected</dt><dd>"), html_escape(py_str(answer)),
        lit("</dd><dt>found</dt><dd>"), html_escape(py_str(extracted)), lit("</dd></dl>"),
    )


def rubric_value(x: str, name: str) -> str:
    p = lit(name + ":" + WS + "*(\\d+)")
    return f"(CASE WHEN regexp_matches({x}, {p}) THEN TRY_CAST(regexp_extract({x}, {p}, 1) AS INTEGER) END)"


# --- more stand-ins --------------------------------------------------------------

DICTIONARY = """dictionary AS (
  SELECT p_partkey AS row_key, p_name AS word,
    CASE WHEN p_partkey % 5 = 1 THEN NULL ELSE lower(p_brand) END AS phonetics,
    CASE WHEN p_partkey % 7 = 3 THEN NULL WHEN p_partkey % 7 = 5 THEN '' ELSE p_type END AS meaning,
    CASE WHEN p_partkey % 4 = 2 THEN NULL ELSE 'noun' END AS pos,
    CASE WHEN p_partkey % 9 = 2 THEN ' ' WHEN p_partkey % 9 = 4 THEN NULL ELSE p_brand END AS origin
  FROM part)"""

DISTIL_INPUT = """distil_input AS (
  SELECT doc_id AS row_key, text AS instruction,
    CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN '  ' ELSE source END AS input,
    CASE WHEN doc_id % 3 = 0 THEN 'done ' || lang WHEN doc_id % 3 = 1 THEN '' ELSE NULL END AS output
  FROM documents)"""

GRADER_OUTPUTS = """grader_outputs AS (
  SELECT doc_id,
    'Content Relevancy: ' || CAST(doc_id % 5 AS VARCHAR) || chr(10)
    || 'Register Appropriateness: ' || CAST((doc_id + quality) % 4 AS VARCHAR) || chr(10)
    || CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'Grammatical and Syntactic Competence: ' || CAST(doc_id % 6 AS VARCHAR) END
    AS grade_output
  FROM labels)"""


def subject_values() -> str:
    rows = ", ".join(f"({lit(s)}, {lit(c)})" for s, c in SUBJECT_CATEGORY)
    return f"subjects(subject, category) AS (VALUES {rows})"


# --- queries ---------------------------------------------------------------------

def exam_long(types: list[str] | None) -> str:
    return exam_scored(types or [])


def scorecard_from(scored_cte: str, eval_name: str) -> str:
    return f"""WITH {scored_cte},
long AS (
  SELECT model_name, type AS metric, score AS value FROM scored
  UNION ALL SELECT model_name, 'score' AS metric, score AS value FROM scored),
{stats_long('long', 'model_name', eval_name)}"""


ALL_TYPES = ["MCQ", "TOF", "FIB", "SHORT_QNA", "LONG_QNA", "METAPHOR_QNA"]


def mmlu_scored() -> str:
    resp = normalize_response("r.response")
    return f"""{MMLU_ITEMS},
{MODEL_RESPONSES},
{subject_values()},
joined AS (
  SELECT r.l_orderkey, r.l_linenumber, r.model_name, i.sample_id, i.answer, {resp} AS response_text
  FROM model_responses r JOIN mmlu_items i ON r.item_id = i.item_id),
extracted AS (SELECT *, {mcq4('response_text')} AS extracted FROM joined),
scored AS (
  SELECT e.*, {exact('extracted', 'answer')} AS score, coalesce(s.category, 'other') AS category
  FROM extracted e LEFT JOIN subjects s ON split_part(e.sample_id, '/', 1) = s.subject)"""


def category_metrics() -> str:
    return f"""WITH {mmlu_scored()},
long AS (
  SELECT model_name, category AS metric, score AS value FROM scored
  UNION ALL SELECT model_name, 'score' AS metric, score AS value FROM scored),
{stats_long('long', 'model_name', 'mmlu_lite')}"""


def metric_stats_override() -> str:
    return f"""WITH {exam_scored(['MCQ', 'FIB', 'TOF'])},
long AS (
  SELECT model_name, type AS metric, score AS value FROM scored
  UNION ALL SELECT model_name, 'score' AS metric, score AS value FROM scored),
agg AS (
  SELECT model_name, metric, avg(value) AS m, stddev_pop(value) AS s, min(value) AS lo, max(value) AS hi
  FROM long GROUP BY model_name, metric)
SELECT 'mg12l' AS eval_name, model_name, metric, round(m, 9) AS value FROM agg WHERE metric <> 'MCQ'
UNION ALL SELECT 'mg12l', model_name, metric || ':std', round(s, 9) FROM agg WHERE metric <> 'MCQ'
UNION ALL SELECT 'mg12l', model_name, metric || ':min', round(lo, 9) FROM agg WHERE metric IN ('MCQ', 'score')
UNION ALL SELECT 'mg12l', model_name, metric || ':max', round(hi, 9) FROM agg WHERE metric IN ('MCQ', 'score')"""


def stream_scorecard() -> str:
    return f"""WITH {exam_scored(['MCQ', 'FIB', 'TOF'])},
long AS (
  SELECT model_name, type AS metric, score AS value FROM scored
  UNION ALL SELECT model_name, 'score' AS metric, score AS value FROM scored)
SELECT 'mg12l' AS eval_name, model_name, metric, count(*) AS n, round(sum(value) / count(*), 9) AS value
FROM long GROUP BY model_name, metric"""


def both_scorecards() -> str:
    return f"SELECT * FROM ({eval_scorecard()}) UNION ALL SELECT * FROM ({category_metrics()})"


def leaderboard() -> str:
    return f"""WITH m AS ({both_scorecards()})
SELECT model_name,
  max(CASE WHEN eval_name = 'mg12l' AND metric = 'score' THEN value END) AS mg12l,
  max(CASE WHEN eval_name = 'mmlu_lite' AND metric = 'score' THEN value END) AS mmlu_lite
FROM m GROUP BY model_name"""


def leaderboard_markdown() -> str:
    return f"""WITH b AS ({leaderboard()})
SELECT 0 AS line_no, '' AS row_key, '| model_name | mg12l | mmlu_lite |' AS line
UNION ALL SELECT 1, '', '|---|---|---|'
UNION ALL SELECT 2, model_name, '| ' || concat_ws(' | ', model_name,
  coalesce(CAST(mg12l AS VARCHAR), ''), coalesce(CAST(mmlu_lite AS VARCHAR), '')) || ' |' FROM b"""


def exact_match_nullsafe() -> str:
    return f"""WITH {exam_scored(ALL_TYPES)}
SELECT l_orderkey, l_linenumber, type, extracted, score FROM scored"""


def mcq_prompt_4() -> str:
    return f"""WITH {MMLU_ITEMS}
SELECT item_id, {mcq_prompt('question', ['option_a', 'option_b', 'option_c', 'option_d'])} AS prompt FROM mmlu_items"""


def typed_prompt_sql() -> str:
    return f"""WITH {EXAM_ITEMS}
SELECT item_id, type, {typed_prompt('type', 'question', 'option_a', 'option_b', 'option_c')} AS prompt FROM exam_items"""


def type_filter() -> str:
    return f"""WITH {EXAM_ITEMS}
SELECT item_id, type, answer FROM exam_items WHERE type IN ('MCQ', 'FIB', 'TOF')"""


def chat_pack() -> str:
    return f"""SELECT doc_id, 0 AS pos, 'system' AS role, {lit(SYSTEM_MESSAGE)} AS content FROM documents
UNION ALL SELECT doc_id, 1 AS pos, 'user' AS role, text AS content FROM documents"""


def _scored_with_items(types: list[str]) -> str:
    return f"""WITH {exam_scored(types)},
full_rows AS (
  SELECT s.*, i.question, i.option_a, i.option_b, i.option_c,
    {typed_prompt('i.type', 'i.question', 'i.option_a', 'i.option_b', 'i.option_c')} AS prompt
  FROM scored s JOIN exam_items i ON s.item_id = i.item_id)"""


def convo_assemble() -> str:
    return f"""{_scored_with_items(ALL_TYPES)}
SELECT l_orderkey, l_linenumber, 0 AS pos, 'user' AS role, prompt AS content FROM full_rows
UNION ALL SELECT l_orderkey, l_linenumber, 1 AS pos, 'assistant' AS role, response_text AS content FROM full_rows"""


def message_html_sql() -> str:
    variant = "(CASE WHEN turn % 3 = 1 THEN '<' || CAST(conv_id % 4 AS VARCHAR) || '>' END)"
    return f"SELECT conv_id, turn, {message_html('role', 'text', variant)} AS html FROM conversations"


def example_html_sql() -> str:
    return f"""{_scored_with_items(['MCQ', 'FIB', 'TOF'])}
SELECT l_orderkey, l_linenumber, {example_html('prompt', 'response_text', 'answer', 'extracted', 'score')} AS html FROM full_rows"""


def grader_prompt_sql() -> str:
    return f"""WITH {EXAM_ITEMS},
{MODEL_RESPONSES}
SELECT r.l_orderkey, r.l_linenumber,
  {grader_prompt('i.question', 'i.answer', normalize_response('r.response'))} AS prompt
FROM model_responses r JOIN exam_items i ON r.item_id = i.item_id WHERE i.type = 'SHORT_QNA'"""


def judge_prompt_sql() -> str:
    return f"""WITH {exam_scored(['MCQ', 'FIB', 'TOF'])}
SELECT l_orderkey, l_linenumber, {judge_prompt('extracted', 'answer')} AS prompt FROM scored"""


def judge_verdict() -> str:
    reply = """(CASE l_linenumber % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN ' yes' || chr(10) WHEN 2 THEN 'No' ELSE 'YES.' END)"""
    return f"SELECT l_orderkey, l_linenumber, lower({py_strip(reply)}) = 'yes' AS equal FROM lineitem"


def normalize_response_sql() -> str:
    return f"""SELECT 'doc' AS src, doc_id AS id, CAST(0 AS BIGINT) AS turn, {normalize_response('text')} AS normalized FROM documents
UNION ALL SELECT 'conv', conv_id, turn, {normalize_response('text')} FROM conversations"""


def _extract_query(expr: str) -> str:
    return f"""WITH {MODEL_RESPONSES},
r AS (SELECT l_orderkey, l_linenumber, {normalize_response('response')} AS t FROM model_responses)
SELECT l_orderkey, l_linenumber, {expr} AS extracted FROM r"""


def answer_extract_open() -> str:
    return f"""WITH {exam_scored(['LONG_QNA', 'METAPHOR_QNA'])}
SELECT l_orderkey, l_linenumber, type, extracted, score FROM scored"""


def answer_extract_english() -> str:
    return f"""WITH r AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber % 3 = 0 THEN 'So the Answer: $' || substr('ABCD', CAST(1 + l_partkey % 4 AS INTEGER), 1) || '$'
      WHEN l_linenumber % 3 = 1 THEN 'answer :  ' || substr('ABCD', CAST(1 + l_partkey % 4 AS INTEGER), 1) || ' because it fits' || chr(10) || 'more'
      ELSE 'I am not sure' END AS t
  FROM lineitem)
SELECT l_orderkey, l_linenumber, {first_match('t', ENGLISH_MCQ_PATTERN)} AS mcq, {first_match('t', ENGLISH_FREE_PATTERN)} AS free FROM r"""


def _rubric_rows(src: str, key: str, text: str) -> str:
    (n1, _, h1), (n2, _, h2), (n3, _, h3) = RUBRIC
    return f"""parsed AS (
  SELECT {key}, {rubric_value(text, n1)} AS content, {rubric_value(text, n2)} AS register,
    {rubric_value(text, n3)} AS grammar, * EXCLUDE ({key}) FROM {src}),
graded AS (
  SELECT *, coalesce(content BETWEEN {RUBRIC[0][1]} AND {RUBRIC[0][2]}, false)
    AND coalesce(register BETWEEN {RUBRIC[1][1]} AND {RUBRIC[1][2]}, false)
    AND coalesce(grammar BETWEEN {RUBRIC[2][1]} AND {RUBRIC[2][2]}, false) AS grade_valid FROM parsed),
rubric AS (
  SELECT *,
    CASE WHEN grade_valid THEN content / {h1}.0 END AS content_score,
    CASE WHEN grade_valid THEN register / {h2}.0 END AS register_score,
    CASE WHEN grade_valid THEN grammar / {h3}.0 END AS grammar_score,
    CASE WHEN grade_valid THEN (content / 3.0 + register / 3.0 + grammar / 5.0) / 3.0 END AS score
  FROM graded)"""


def rubric_scores() -> str:
    return f"""WITH {GRADER_OUTPUTS},
{_rubric_rows('grader_outputs', 'doc_id', 'grade_output')}
SELECT doc_id, content, register, grammar, grade_valid, round(score, 9) AS score,
  round(content_score, 9) AS content_score, round(register_score, 9) AS register_score,
  round(grammar_score, 9) AS grammar_score
FROM rubric"""


def _rubric_long(group: str) -> str:
    return f"""long AS (
  SELECT {group}, 'SHORT_QNA' AS metric, score AS value FROM rubric WHERE grade_valid
  UNION ALL SELECT {group}, 'Content Relevancy', content_score FROM rubric WHERE grade_valid
  UNION ALL SELECT {group}, 'Register Appropriateness', register_score FROM rubric WHERE grade_valid
  UNION ALL SELECT {group}, 'Grammatical and Syntactic Competence', grammar_score FROM rubric WHERE grade_valid
  UNION ALL SELECT {group}, 'score', score FROM rubric WHERE score IS NOT NULL)"""


def rubric_aggregate() -> str:
    return f"""WITH {GRADER_OUTPUTS},
g2 AS (SELECT g.doc_id, g.grade_output, CAST(l.quality AS BIGINT) AS quality FROM grader_outputs g JOIN labels l ON g.doc_id = l.doc_id),
{_rubric_rows('g2', 'doc_id', 'grade_output')},
{_rubric_long('quality')},
agg AS (SELECT quality, metric, avg(value) AS m, stddev_pop(value) AS s FROM long GROUP BY quality, metric)
SELECT quality, metric, round(m, 9) AS value FROM agg
UNION ALL SELECT quality, metric || ':std', round(s, 9) FROM agg"""


def model_graded_exam() -> str:
    gp = grader_prompt("i.question", "i.answer", normalize_response("r.response"))
    return f"""WITH {EXAM_ITEMS},
{MODEL_RESPONSES},
sq AS (
  SELECT r.l_orderkey, r.model_name, length({gp}) AS n
  FROM model_responses r JOIN exam_items i ON r.item_id = i.item_id WHERE i.type = 'SHORT_QNA'),
rubric AS (
  SELECT model_name, n % 6 BETWEEN 1 AND 5 AS grade_valid,
    CASE WHEN n % 6 BETWEEN 1 AND 5 THEN (n % 4) / 3.0 END AS content_score,
    CASE WHEN n % 6 BETWEEN 1 AND 5 THEN (n % 3) / 3.0 END AS register_score,
    CASE WHEN n % 6 BETWEEN 1 AND 5 THEN (n % 6) / 5.0 END AS grammar_score,
    CASE WHEN n % 6 BETWEEN 1 AND 5 THEN ((n % 4) / 3.0 + (n % 3) / 3.0 + (n % 6) / 5.0) / 3.0 END AS score
  FROM sq),
{_rubric_long('model_name')},
{stats_long('long', 'model_name', 'mg12l')}"""


def sample_fixed() -> str:
    return "SELECT doc_id, lang FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || '|0'), doc_id LIMIT 100"


def debug_head() -> str:
    return "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 5"


# The variables of each default template group, in order, written out here.
GROUP_VARIABLES = [["meaning", "word"], ["meaning", "word"], ["phonetics", "word"], ["origin", "word"], ["pos", "word"]]


def _pick(key: str, gid: str, n: int) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '|' || CAST({gid} AS VARCHAR) || '|0'), 1, 8))::BIGINT % {n} AS INTEGER)"


def _bad(v: str) -> str:
    return f"({v} IS NULL OR {v} = '')"


def _pairs() -> str:
    gids = ", ".join(f"({i})" for i in range(len(DEFAULT_TEMPLATE_GROUPS)))
    first_bad = []
    picks = []
    for gid, group in enumerate(DEFAULT_TEMPLATE_GROUPS):
        vars_ = GROUP_VARIABLES[gid]
        cases = " ".join(f"WHEN {_bad(v)} THEN {lit(v)}" for v in vars_)
        first_bad.append(f"WHEN {gid} THEN (CASE {cases} END)")
        picks.append(f"WHEN {gid} THEN {_pick('d.row_key', 'g.group_id', len(group))}")
    return f"""{DICTIONARY},
pairs AS (
  SELECT d.*, g.group_id,
    CASE g.group_id {' '.join(first_bad)} END AS bad_variable,
    CASE g.group_id {' '.join(picks)} END AS template_id
  FROM dictionary d CROSS JOIN (VALUES {gids}) g(group_id))"""


def _templates_values() -> str:
    rows = []
    for gid, group in enumerate(DEFAULT_TEMPLATE_GROUPS):
        for tid, t in enumerate(group):
            for pos, m in enumerate(t):
                rows.append(f"({gid}, {tid}, {pos}, {lit(m['role'])}, {lit(m['content'])})")
    return f"templates(group_id, template_id, pos, role, content) AS (VALUES {', '.join(rows)})"


def template_vars() -> str:
    return r"""WITH t AS (
  SELECT source, text || CASE doc_id % 3 WHEN 0 THEN '{{lang}} {{lang}}' WHEN 1 THEN '{{ title }} {{v' || CAST(doc_id % 7 AS VARCHAR) || '}}'
    ELSE '{lang}} {{open' || chr(10) || '}}' END AS text FROM documents),
n AS (SELECT source, unnest(list_distinct(regexp_extract_all(coalesce(text, ''), '\{\{(.*?)\}\}', 1))) AS name FROM t)
SELECT source, name, count(*) AS n_texts FROM n GROUP BY source, name"""


def template_reject_counts() -> str:
    """The column ``origin`` is missing: its group is rejected for it, sorted before ``word``."""
    return f"""WITH {_pairs()},
r AS (SELECT CASE WHEN group_id = 3 THEN 'origin' ELSE bad_variable END AS variable, group_id FROM pairs)
SELECT CASE WHEN variable = 'origin' THEN 'variable not found' ELSE 'value not valid' END AS reason, variable, count(*) AS n
FROM r WHERE variable IS NOT NULL GROUP BY variable"""


def template_generate() -> str:
    fills = []
    for gid, group in enumerate(DEFAULT_TEMPLATE_GROUPS):
        expr = "t.content"
        for v in GROUP_VARIABLES[gid]:
            expr = f"replace({expr}, {lit('{{' + v + '}}')}, p.{v})"
        fills.append(f"WHEN {gid} THEN {expr}")
    return f"""WITH {_pairs()},
{_templates_values()}
SELECT p.row_key, p.group_id, p.template_id, t.pos, t.role, CASE p.group_id {' '.join(fills)} END AS content
FROM pairs p JOIN templates t ON p.group_id = t.group_id AND p.template_id = t.template_id
WHERE p.bad_variable IS NULL"""


def template_rejects() -> str:
    return f"""WITH {_pairs()}
SELECT row_key, group_id, bad_variable AS variable, 'value not valid' AS reason FROM pairs WHERE bad_variable IS NOT NULL"""


def distil_pending() -> str:
    return f"WITH {DISTIL_INPUT} SELECT row_key FROM distil_input WHERE {is_blank('output')}"


def distil_prompt_alpaca() -> str:
    return f"WITH {DISTIL_INPUT} SELECT row_key, {alpaca('instruction', 'input')} AS prompt FROM distil_input"


def distil_prompt_simple() -> str:
    return f"WITH {DISTIL_INPUT} SELECT row_key, coalesce(input, '') AS prompt FROM distil_input"


def _distil_rows() -> str:
    return f"""{DISTIL_INPUT},
d AS (
  SELECT row_key, output, {is_blank('output')} AS pending, length({alpaca('instruction', 'input')}) AS n
  FROM distil_input)"""


def distil_merge() -> str:
    return f"""WITH {_distil_rows()}
SELECT row_key, CASE WHEN pending AND n % 7 <> 3 THEN 'reply ' || CAST(n AS VARCHAR) ELSE output END AS output FROM d"""


def distil_stats() -> str:
    return f"""WITH {_distil_rows()}
SELECT count(*) AS total_rows, count(*) FILTER (WHERE pending AND n % 7 <> 3) AS processed,
  count(*) FILTER (WHERE pending AND n % 7 = 3) AS errors, count(*) FILTER (WHERE NOT pending) AS skipped,
  count(*) FILTER (WHERE pending) AS calls
FROM d"""


def distil_errors() -> str:
    return f"""WITH {_distil_rows()}
SELECT row_key, 'synthetic failure' AS error, 'Row ' || CAST(row_key AS VARCHAR) || ': synthetic failure' AS detail
FROM d WHERE pending AND n % 7 = 3"""


def distil_resume() -> str:
    return f"""WITH {_distil_rows()},
r AS (SELECT *, pending AND NOT (n % 5 <> 0 AND n % 7 <> 3) AS again FROM d)
SELECT count(*) AS total_rows, count(*) FILTER (WHERE again AND n % 7 <> 3) AS processed,
  count(*) FILTER (WHERE again AND n % 7 = 3) AS errors, count(*) FILTER (WHERE NOT again) AS skipped,
  count(*) FILTER (WHERE again) AS calls
FROM r"""


def csv_roundtrip() -> str:
    nas = ", ".join(lit(v) for v in NA_STRINGS)
    cols = ", ".join(f"CASE WHEN {c} IN ({nas}) THEN NULL ELSE {c} END AS {c}" for c in ("instruction", "input", "output"))
    return f"WITH {DISTIL_INPUT} SELECT row_key, {cols} FROM distil_input"


def report_rows() -> str:
    ex = example_html("prompt", "response_text", "answer", "extracted", "score")
    return f"""{_scored_with_items(['MCQ', 'FIB', 'TOF'])},
metrics AS ({eval_scorecard()}),
ex AS (SELECT 'mg12l' AS eval_name, model_name, 'response-to-order-line-' || CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS item_id, {ex} AS html FROM full_rows),
groups AS (SELECT DISTINCT eval_name, model_name FROM metrics),
tgroups AS (SELECT DISTINCT eval_name, model_name FROM metrics WHERE metric <> 'score')
SELECT eval_name, model_name, 0 AS section, '' AS ord, '' AS sub, {lit(REPORT_HEAD)} AS line FROM groups
UNION ALL SELECT eval_name, model_name, 1, '', '', '<section><h1>Scores</h1><table class="metrics">' FROM tgroups
UNION ALL SELECT m.eval_name, m.model_name, 2, CASE WHEN metric = 'score' THEN '0' ELSE '1' END, metric,
  CASE WHEN metric = 'score' THEN '<tr class="overall"><td>overall score</td><td>' || CAST(round(coalesce(value, 0.0), 3) AS VARCHAR) || '</td></tr>'
  ELSE '<tr><td>' || {html_escape('metric')} || '</td><td>' || {py_str('value')} || '</td></tr>' END
  FROM metrics m SEMI JOIN tgroups t ON m.eval_name = t.eval_name AND m.model_name = t.model_name
UNION ALL SELECT eval_name, model_name, 3, '', '', '</table></section>' FROM tgroups
UNION ALL SELECT eval_name, model_name, 4, '', '', '<section><h1>Answers</h1>' FROM groups
UNION ALL SELECT eval_name, model_name, 5, item_id, '', html || '</article>' FROM ex
UNION ALL SELECT eval_name, model_name, 6, '', '', {lit('</section>' + REPORT_TAIL)} FROM groups"""


def _e2e_scored() -> str:
    mm_prompt = mcq_prompt("question", ["option_a", "option_b", "option_c", "option_d"])
    ex_prompt = typed_prompt("type", "question", "option_a", "option_b", "option_c")
    ma = "'Reasoning.' || chr(10) || 'အဖြေ: (' || substr('ကခဂဃ', CAST(1 + n % 4 AS INTEGER), 1) || ')'"
    mb = "CASE n % 4 WHEN 0 THEN '**အဖြေ: မှန်**' WHEN 1 THEN 'အဖြေ: Brand#3' WHEN 2 THEN '$အဖြေ: ဂ$' ELSE 'no answer' END"
    return f"""{MMLU_ITEMS},
{EXAM_ITEMS},
{subject_values()},
models(model_name) AS (VALUES ('ma'), ('mb')),
mp AS (SELECT item_id, sample_id, answer, length({mm_prompt}) AS n FROM mmlu_items),
ep AS (SELECT item_id, type, answer, length({ex_prompt}) AS n FROM exam_items WHERE type IN ('MCQ', 'FIB', 'TOF')),
mr AS (
  SELECT m.model_name, p.sample_id, p.answer,
    {normalize_response(f"CASE m.model_name WHEN 'ma' THEN {ma} ELSE {mb} END")} AS t
  FROM mp p CROSS JOIN models m),
er AS (
  SELECT m.model_name, p.type, p.answer,
    {normalize_response(f"CASE m.model_name WHEN 'ma' THEN {ma} ELSE {mb} END")} AS t
  FROM ep p CROSS JOIN models m),
ms AS (
  SELECT model_name, coalesce(s.category, 'other') AS cat, {exact(mcq4('t'), 'answer')} AS score
  FROM mr LEFT JOIN subjects s ON split_part(mr.sample_id, '/', 1) = s.subject),
es AS (SELECT model_name, type, {exact(by_type('type', 't', 'answer'), 'answer')} AS score FROM er),
long AS (
  SELECT 'mmlu_lite' AS eval_name, model_name, cat AS metric, score AS value FROM ms
  UNION ALL SELECT 'mmlu_lite', model_name, 'score', score FROM ms
  UNION ALL SELECT 'mg12l', model_name, type, score FROM es
  UNION ALL SELECT 'mg12l', model_name, 'score', score FROM es),
agg AS (SELECT eval_name, model_name, metric, avg(value) AS m, stddev_pop(value) AS s FROM long GROUP BY ALL)"""


def eval_run_metrics() -> str:
    return f"""WITH {_e2e_scored()}
SELECT eval_name, model_name, metric, round(m, 9) AS value FROM agg
UNION ALL SELECT eval_name, model_name, metric || ':std', round(s, 9) FROM agg"""


def eval_run_leaderboard() -> str:
    return f"""WITH {_e2e_scored()}
SELECT model_name,
  round(max(CASE WHEN eval_name = 'mg12l' AND metric = 'score' THEN m END), 9) AS mg12l,
  round(max(CASE WHEN eval_name = 'mmlu_lite' AND metric = 'score' THEN m END), 9) AS mmlu_lite
FROM agg GROUP BY model_name"""


def eval_run_failures() -> str:
    prompt = typed_prompt("type", "question", "option_a", "option_b", "option_c")
    reply = normalize_response("'Reasoning.' || chr(10) || 'အဖြေ: (' || substr('ကခဂဃ', CAST(1 + n % 4 AS INTEGER), 1) || ')'")
    return f"""WITH {EXAM_ITEMS},
p AS (SELECT *, length({prompt}) AS n FROM exam_items),
a AS (SELECT type, n % 7 = 3 AS failed, length({grader_prompt('question', 'answer', reply)}) AS g FROM p)
SELECT 'mg12l' AS eval_name, 'ma' AS model_name, count(*) AS n_rows, count(*) FILTER (failed) AS n_errors,
  count(*) FILTER (NOT failed AND type = 'SHORT_QNA' AND (g % 5 = 0 OR g % 6 = 0)) AS n_invalid_grades, false AS no_score FROM a
UNION ALL SELECT 'mg12l', 'mb', count(*), count(*), 0, true FROM a"""


def eval_run_rerun() -> str:
    return f"""WITH {_e2e_scored()}
SELECT eval_name, model_name, metric, round(m, 9) AS value FROM agg WHERE eval_name = 'mmlu_lite'
UNION ALL SELECT eval_name, model_name, metric || ':std', round(s, 9) FROM agg WHERE eval_name = 'mmlu_lite'
UNION ALL SELECT 'mmlu_lite', model_name, 'report heads', 1.0 FROM models
UNION ALL SELECT 'mmlu_lite', m.model_name, 'report examples', CAST(count(*) AS DOUBLE) FROM models m CROSS JOIN part GROUP BY m.model_name"""


def retry_policies() -> str:
    return f"""WITH d AS (SELECT doc_id, length(text) AS n FROM documents),
r AS (SELECT doc_id, n, CASE WHEN n % 5 = 0 THEN 'rate Limit reached' WHEN n % 7 = 0 THEN 'refused' WHEN n % 11 = 0 THEN 'synthetic failure' END AS error FROM d)
SELECT 'careful' AS policy, doc_id,
  CASE WHEN error = 'refused' THEN {lit(BAD_REQUEST_TEXT)} WHEN error IS NULL THEN 'reply ' || CAST(n AS VARCHAR) END AS response,
  CASE WHEN error <> 'refused' THEN error END AS error, CASE WHEN error LIKE 'rate%' THEN 3 ELSE 1 END AS attempts FROM r
UNION ALL SELECT 'stubborn', doc_id, CASE WHEN error IS NULL THEN 'reply ' || CAST(n AS VARCHAR) END, error,
  CASE WHEN error IS NULL THEN 1 ELSE 2 END FROM r"""


def extract_documents() -> str:
    answer = """CASE doc_id % 3 WHEN 0 THEN '(' || substr('ကခဂဃ', CAST(1 + doc_id % 4 AS INTEGER), 1) || ')' WHEN 1 THEN 'မှန်' ELSE '(word ' || CAST(doc_id AS VARCHAR) || ')' END"""
    text = normalize_response(f"(coalesce(text, '') || chr(10) || '**အဖြေ: ' || {answer} || '**')")
    return f"""WITH t AS (SELECT doc_id, {text} AS t FROM documents)
SELECT doc_id, {mcq4('t')} AS mcq, {tof('t')} AS tof, {fib('t')} AS fib FROM t"""


def exam_mcq_word_answer() -> str:
    given = "CASE p_partkey % 4 WHEN 0 THEN answer WHEN 1 THEN lower(answer) WHEN 2 THEN 'ခ' ELSE p_brand END"
    text = normalize_response(f"('so' || chr(10) || 'အဖြေ : (' || {given} || ') end')")
    return f"""WITH a AS (SELECT p_partkey, p_brand, '[' || p_brand || '.*+?|^)' AS answer FROM part),
t AS (SELECT p_partkey, answer, {text} AS t FROM a)
SELECT p_partkey AS item_id, {exam_mcq('t', 'answer')} AS extracted FROM t"""


def graded_rows() -> str:
    parts = [("SHORT_QNA", "score"), ("Content Relevancy", "content_score"), ("Register Appropriateness", "register_score"), ("Grammatical and Syntactic Competence", "grammar_score")]
    text = " || ', ' || ".join(f"""'"{name}": ' || CAST(CAST({column} AS DOUBLE) AS VARCHAR)""" for name, column in parts)
    return f"""WITH {GRADER_OUTPUTS},
{_rubric_rows('grader_outputs', 'doc_id', 'grade_output')}
SELECT doc_id, '{{' || CASE WHEN grade_valid THEN {text} ELSE '' END || '}}' AS extracted, round(score, 9) AS score, grade_valid FROM rubric"""


def distil_null_prompts() -> str:
    return """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 0 ELSE length(text) END AS n FROM documents)
SELECT unnest(['first', 'overwrite']) AS run, count(*) AS total_rows, count(*) FILTER (n > 0 AND n % 7 <> 3) AS processed,
  count(*) FILTER (n = 0 OR n % 7 = 3) AS errors, 0 AS skipped, count(*) FILTER (n > 0) AS calls FROM d"""


def judge_equality() -> str:
    return f"""WITH {exam_scored(['MCQ', 'FIB', 'TOF'])}
SELECT l_orderkey, l_linenumber, length({judge_prompt('extracted', 'answer')}) % 3 = 0 AS equal FROM scored"""


def multimodal_parts() -> str:
    return """SELECT page_id, 0 AS pos, 'text' AS type, url AS text, CAST(NULL AS VARCHAR) AS image_url FROM pages
UNION ALL SELECT page_id, 1, 'image_url', CAST(NULL AS VARCHAR), 'data:image/png;base64,' || to_base64(encode(html)) FROM pages"""


def all_sql() -> dict[str, str]:
    return {
        "eval_run_metrics": eval_run_metrics(),
        "eval_run_leaderboard": eval_run_leaderboard(),
        "judge_equality": judge_equality(),
        "eval_run_failures": eval_run_failures(),
        "eval_run_rerun": eval_run_rerun(),
        "retry_policies": retry_policies(),
        "extract_documents": extract_documents(),
        "exam_mcq_word_answer": exam_mcq_word_answer(),
        "graded_rows": graded_rows(),
        "template_reject_counts": template_reject_counts(),
        "dictionary_csv": template_generate(),
        "distil_null_prompts": distil_null_prompts(),
        "multimodal_parts": multimodal_parts(),
        "eval_scorecard": eval_scorecard(),
        "category_metrics": category_metrics(),
        "metric_stats_override": metric_stats_override(),
        "leaderboard": leaderboard(),
        "leaderboard_markdown": leaderboard_markdown(),
        "exact_match_nullsafe": exact_match_nullsafe(),
        "stream_scorecard": stream_scorecard(),
        "mcq_prompt_4": mcq_prompt_4(),
        "typed_prompt": typed_prompt_sql(),
        "type_filter": type_filter(),
        "chat_pack": chat_pack(),
        "convo_assemble": convo_assemble(),
        "message_html": message_html_sql(),
        "example_html": example_html_sql(),
        "grader_prompt": grader_prompt_sql(),
        "judge_prompt": judge_prompt_sql(),
        "judge_verdict": judge_verdict(),
        "normalize_response": normalize_response_sql(),
        "answer_extract_mcq": _extract_query(mcq4("t")),
        "answer_extract_tof": _extract_query(tof("t")),
        "answer_extract_fib": _extract_query(fib("t")),
        "answer_extract_open": answer_extract_open(),
        "answer_extract_english": answer_extract_english(),
        "rubric_scores": rubric_scores(),
        "rubric_aggregate": rubric_aggregate(),
        "model_graded_exam": model_graded_exam(),
        "sample_fixed": sample_fixed(),
        "debug_head": debug_head(),
        "template_vars": template_vars(),
        "template_generate": template_generate(),
        "template_rejects": template_rejects(),
        "sft_jsonl_roundtrip": template_generate(),
        "distil_pending": distil_pending(),
        "distil_prompt_alpaca": distil_prompt_alpaca(),
        "distil_prompt_simple": distil_prompt_simple(),
        "distil_merge": distil_merge(),
        "distil_stats": distil_stats(),
        "distil_errors": distil_errors(),
        "distil_resume": distil_resume(),
        "csv_roundtrip": csv_roundtrip(),
        "metrics_roundtrip": both_scorecards(),
        "report_rows": report_rows(),
    }
