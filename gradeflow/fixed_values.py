"""Values that must equal the evaluated toolkit's for results to agree.

Everything in this module is a FIXED VALUE: answer markers, option labels,
normalisation removals, rubric names and ranges, the subject table and the
missing-value strings.  They are stated plainly, in their natural order.
Prompt wording and chat templates are *not* here: those are our own defaults
(see ``gradeflow.operators.prompts`` and ``gradeflow.operators.generate``).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — question types (in this order)
# ---------------------------------------------------------------------------
QUESTION_TYPES = ["MCQ", "TOF", "FIB", "SHORT_QNA", "LONG_QNA", "METAPHOR_QNA"]
OPEN_QUESTION_TYPES = ["SHORT_QNA", "LONG_QNA", "METAPHOR_QNA"]
DEFAULT_EXAM_TYPES = ["MCQ", "FIB", "TOF"]
UNKNOWN_TYPE_MESSAGE = "Unknown question type: "

# ---------------------------------------------------------------------------
# FIXED VALUES — Burmese option labels (A, B, C, D) and true/false words
# ---------------------------------------------------------------------------
OPTION_LABELS = ["က", "ခ", "ဂ", "ဃ"]
OPTION_LETTERS = ["A", "B", "C", "D"]
TRUE_WORD = "မှန်"
FALSE_WORD = "မှား"

# ---------------------------------------------------------------------------
# FIXED VALUES — literal removals of the response normaliser, in order
# ---------------------------------------------------------------------------
RESPONSE_REMOVALS = [
    "**",
    "$\\boxed{",
    "}$",
    "\\$",
    "$\\text{",
    "$",
    "\\mathrm{",
    "\\{",
    "\\text",
    "\\(",
    "\\mathbf{",
    "{",
    "\\boxed",
]

# ---------------------------------------------------------------------------
# FIXED VALUES — answer patterns (Python ``re`` syntax, as the toolkit wrote them)
# ---------------------------------------------------------------------------
ANSWER_HEAD = "အဖြေ\\s*:(?:\\n{0,2})?"
MCQ_TAIL = "[ \\t]*(?:\\()?([က-ဃ]|[က]|[ခ]|[ဂ]|[ဃ])(?:\\))?"
TOF_TAIL = "[ \\t]*(?:\\()?(မှန်|မှား)(?:\\))?"
FIB_TAIL = "[ \\t]*(?:\\()?(.*?)(?:\\))?$"
ENGLISH_MCQ_PATTERN = "Answer[ \\t]*:[ \\t]*\\$?([A-D])\\$?"
ENGLISH_FREE_PATTERN = "Answer\\s*:\\s*([^\\n]+)"
SLOT_PATTERN = "{{(.*?)}}"  # a template variable slot

# Characters Python's ``str.strip`` / ``re`` ``\s`` treat as white space.
# Java's ``(?U)\s`` lacks U+001C..U+001F, so the class is spelled out.
PY_WHITESPACE_CLASS = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)

# ---------------------------------------------------------------------------
# FIXED VALUES — rubric criteria with inclusive ranges (in this order)
# ---------------------------------------------------------------------------
RUBRIC = [
    ("Content Relevancy", 0, 3),
    ("Register Appropriateness", 0, 3),
    ("Grammatical and Syntactic Competence", 1, 5),
]
SHORT_QNA_METRIC = "SHORT_QNA"

# ---------------------------------------------------------------------------
# FIXED VALUES — other literals
# ---------------------------------------------------------------------------
JUDGE_YES = "yes"
EMPTY_PROMPT_ERROR = "Formatter function returned empty content"
BAD_REQUEST_TEXT = "No response (bad request)."
DEFAULT_STATS = ("mean", "std")
KNOWN_STATS = ("mean", "std", "min", "max")
EVAL_NAMES = ["mmlu_lite", "mg12l"]

# ---------------------------------------------------------------------------
# FIXED VALUES — MMLU subject -> category (57 rows, natural order)
# ---------------------------------------------------------------------------
SUBJECT_CATEGORY = [
    ("abstract_algebra", "stem"),
    ("anatomy", "other"),
    ("astronomy", "stem"),
    ("business_ethics", "other"),
    ("clinical_knowledge", "other"),
    ("college_biology", "stem"),
    ("college_chemistry", "stem"),
    ("college_computer_science", "stem"),
    ("college_mathematics", "stem"),
    ("college_medicine", "other"),
    ("college_physics", "stem"),
    ("computer_security", "stem"),
    ("conceptual_physics", "stem"),
    ("econometrics", "social_sciences"),
    ("electrical_engineering", "stem"),
    ("elementary_mathematics", "stem"),
    ("formal_logic", "humanities"),
    ("global_facts", "other"),
    ("high_school_biology", "stem"),
    ("high_school_chemistry", "stem"),
    ("high_school_computer_science", "stem"),
    ("high_school_european_history", "humanities"),
    ("high_school_geography", "social_sciences"),
    ("high_school_government_and_politics", "social_sciences"),
    ("high_school_macroeconomics", "social_sciences"),
    ("high_school_mathematics", "stem"),
    ("high_school_microeconomics", "social_sciences"),
    ("high_school_physics", "stem"),
    ("high_school_psychology", "social_sciences"),
    ("high_school_statistics", "stem"),
    ("high_school_us_history", "humanities"),
    ("high_school_world_history", "humanities"),
    ("human_aging", "other"),
    ("human_sexuality", "social_sciences"),
    ("international_law", "humanities"),
    ("jurisprudence", "humanities"),
    ("logical_fallacies", "humanities"),
    ("machine_learning", "stem"),
    ("management", "other"),
    ("marketing", "other"),
    ("medical_genetics", "other"),
    ("miscellaneous", "other"),
    ("moral_disputes", "humanities"),
    ("moral_scenarios", "humanities"),
    ("nutrition", "other"),
    ("philosophy", "humanities"),
    ("prehistory", "humanities"),
    ("professional_accounting", "other"),
    ("professional_law", "humanities"),
    ("professional_medicine", "other"),
    ("professional_psychology", "social_sciences"),
    ("public_relations", "social_sciences"),
    ("security_studies", "social_sciences"),
    ("sociology", "social_sciences"),
    ("us_foreign_policy", "social_sciences"),
    ("virology", "other"),
    ("world_religions", "humanities"),
]
DEFAULT_CATEGORY = "other"

# ---------------------------------------------------------------------------
# FIXED VALUES — strings a CSV reader treats as missing (pandas 2.x default)
# ---------------------------------------------------------------------------
NA_STRINGS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
