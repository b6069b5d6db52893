"""Text, answer and LaTeX checks as columns (T1-T7, T9-T13, T15, T16, T19, T23-T30, T32-T34); what no regular
expression can express is in examlake.functions.parse."""

from __future__ import annotations

import json
import re
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the gates, all down to CONCLUSIONS: vague words, commands, rejected style words, opening words, the
# style suffix, doubled commands, markers of held records, signs of code and LaTeX, typos, and what gives an answer away.
VAGUE_WORDS = ("several", "some", "a few", "many", "various", "multiple")
COMMANDS = ("\\frac", "\\sqrt", "\\sum", "\\int", "\\alpha", "\\beta", "\\gamma", "\\theta", "\\lambda", "\\binom")
SUFFIX_WORDS = ("textbook illustration", "no shading", "no 3D perspective", "no drop shadows", "no gradients")
OPENINGS = (
    "A\\s", "An\\s", "Diagram", "Chart", "Graph", "Engineering", "Technical", "Scientific", "Physics", "Chemical", "Biological", "Mechanical", "Electrical", "Circuit", "Structure",
    "Cross-section", "Flowchart", "Table", "Plot", "Map", "Schematic", "Venn", "Bar", "Scatter", "Line", "Histogram", "Tree", "Network",
)
STYLE_SUFFIX = "Clean academic textbook illustration style, white background, thin black outlines, no shading, no 3D perspective, no drop shadows, no gradients, high contrast, clearly legible labels."
DOUBLED_COMMANDS = ("$", "\\\\frac", "\\\\alpha", "\\\\beta", "\\\\gamma", "\\\\sum", "\\\\int", "\\\\sqrt")
HOLD_MARKERS, QUARANTINED = ("qwen_tech", "http", "timeout", "parse", "control character", "控制字符"), "recycle_quarantine"
PYTHON_SIGNS = ("import ", "plt.", "np.", "def ", "fig,", "ax.", "matplotlib")
LATEX_SIGNS = r"\\begin\{(circuitikz|tikzpicture|document|figure)\}|\\documentclass|\\usepackage|\\draw\b"
RAW_COMMANDS = ("frac", "alpha", "beta", "gamma", "sum", "int", "sqrt", "begin", "end")
TYPOS = ("\\rac", "\\farc", "\\frc")
CONCLUSIONS = (
    r"\banswer\s+is\b", r"\boption\s+[abcd]\s+(?:is\s+)?correct\b", r"\bcorrect\s+(?:answer|option)\b", r"\bshortest\s+path\b", r"\blongest\s+path\b", r"\bpath\s+total\b",
    r"\btotal\s+(?:cost|weight|length)\s+(?:is|=)(?=[\p{L}\p{N}_])|\btotal\s+(?:cost|weight|length)\s+is\b", r"\bminimum\b", r"\bmaximum\b", r"\bmin\b", r"\bmax\b", r"\bbest\b", r"\bworst\b",
    "最短路径", "最长路径", "正确答案", "正确选项", "答案是", "最大值", "最小值", "最终排序", "最终类别",
)


def mixed_words(text: Column) -> Column:
    """Words, each run of CJK characters counting as one."""
    # Each run of either kind shrinks to one letter, blanks go, and the letters are counted: no array of words.
    joined = F.regexp_replace(F.coalesce(text, F.lit("")), "[\\u4e00-\\u9fff]++", " Z ")
    return F.length(F.regexp_replace(F.regexp_replace(joined, r"(?U)\S++", "x"), r"(?U)\s++", ""))


def control_chars(text: Column) -> Column:
    """Whether a control character other than tab, line feed and return occurs."""
    return text.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")


def first_control(text: Column) -> Column:
    """The first control character as U+XXXX, or null."""
    found = F.regexp_extract(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", 0)
    return F.when(control_chars(text), F.format_string("U+%04X", F.ascii(found)))


def occurrences(text: Column, part: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(part)))) / len(part)).cast("int")


def unbalanced(text: Column) -> Column:
    """Odd dollar signs, or unequal LaTeX brackets (T4)."""
    return (occurrences(text, "$") % 2 != 0) | (occurrences(text, "\\(") != occurrences(text, "\\)")) | (occurrences(text, "\\[") != occurrences(text, "\\]"))


# Fields of a record whose strings the quarantine reads, spans of math, signs of LaTeX.
LATEX_FIELDS = ("question_text", "explanation", "image_prompt", "final_image_prompt", "image_dependency_reason", "options", "truth_spec")
MATH = tuple(re.compile(p, re.DOTALL) for p in (r"\$\$.*?\$\$", r"\$[^$\n]+\$", r"\\\(.*?\\\)", r"\\\[.*?\\\]"))
LATEX_SIGNAL = r"\\[A-Za-z]+|\\[\[(]|\$\$|(?<!\\)\$(?!\$)"


def _record(raw: str | None) -> tuple[str, str | None]:
    try:
        record = json.loads(raw or "")
    except (ValueError, RecursionError):
        return "broken", None
    if not isinstance(record, dict):
        return type(record).__name__, None
    named = [record[f] for f in LATEX_FIELDS if f in record]
    out, rest = [], [named or record]
    while rest:
        x = rest.pop()
        if isinstance(x, str):
            out.append(x)
        elif isinstance(x, dict | list):
            rest += reversed(list(x.values()) if isinstance(x, dict) else x)
    return "object", "\n".join(out)


def record(raw: Column) -> Column:
    """(kind, text) of JSON: kind object, broken, or else the root's type (list, str, int, float, bool, NoneType), and of an object the strings within its LATEX_FIELDS, at any
    depth, one a line, or all its strings if it has none of these fields (T25).

    Python over Arrow batches: try_parse_json takes text with a rest behind the value, such as '{}}', for whole.
    """

    @F.pandas_udf("kind string, text string")
    def run(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_record(v) for v in values], columns=["kind", "text"])

    return run(raw)


def latex_faults(text: Column) -> Column:
    """If text shows LaTeX at all: the names of brackets that do not pair up, and of an odd count of double dollars (T5)."""
    uneven = lambda a, b: occurrences(text, a) != occurrences(text, b)
    faults = [F.when(uneven("\\(", "\\)"), "unbalanced_latex_inline_delimiter"), F.when(uneven("\\[", "\\]"), "unbalanced_latex_display_delimiter"), F.when(occurrences(text, "$$") % 2 != 0, "unbalanced_latex_double_dollar")]
    found = F.filter(F.array(*faults), lambda x: x.isNotNull())
    return F.when(text.rlike(LATEX_SIGNAL), found).otherwise(F.array().cast("array<string>"))


def _blanked(text: str | None) -> str | None:
    if text is None or not set(text) & set("$\\"):
        return text
    out = list(text)
    for kind in MATH:
        for m in kind.finditer(text):
            out[m.start() : m.end()] = " " * (m.end() - m.start())
    return "".join(out)


def without_math(text: Column) -> Column:
    r"""Text with the math spans of $$, $, \( and \[ as blanks of their length.

    Each kind of span is looked for by itself, so that what stands between two $$ spans counts as math too. Python over
    Arrow batches, as spans that overlap cannot be blanked one after the other.
    """

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(_blanked)

    return run(text)


def bare_command(text: Column) -> Column:
    """The first of COMMANDS that stands outside math, or null (T7); only texts with one of them are searched."""
    outside = without_math(text)
    return F.when(contains_any_case(text, COMMANDS), F.coalesce(*[F.when(F.contains(outside, F.lit(c)), F.lit(c)) for c in COMMANDS]))


def contains_any_case(text: Column, parts: tuple[str, ...]) -> Column:
    """Whether one of the parts stands in text, in this case."""
    return reduce(or_, [F.contains(text, F.lit(p)) for p in parts])


def environments_differ(text: Column) -> Column:
    """Whether the names begun and the names ended are not the same in the same order."""
    begun, ended = (F.regexp_extract_all(text, F.lit(r"\\" + word + r"\{([^{}]+)\}"), F.lit(1)) for word in ("begin", "end"))
    return begun != ended


def typo(text: Column) -> Column:
    """Whether a broken command stands in text: one of TYPOS, or rac{ after no letter or backslash."""
    return contains_any(text, TYPOS) | text.rlike(r"(^|[^a-zA-Z\\])rac\{")


def raw_marker(text: Column) -> Column:
    """The first raw LaTeX marker that a drawing prompt shows: $, then RAW_COMMANDS; or null."""
    marks = ["$", *("\\" + c for c in RAW_COMMANDS)]  # a doubled backslash holds the single one
    return F.coalesce(*[F.when(F.contains(text, F.lit(m)), F.lit(m)) for m in marks])


def doubled_marker(text: Column) -> Column:
    """The first of the generator's markers, which doubles backslashes, that a drawing prompt shows; or null."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(m)), F.lit(m)) for m in DOUBLED_COMMANDS])


def concludes(text: Column) -> Column:
    """Whether a text, normalised, gives a conclusion away."""
    return normalised(text).rlike("(?U)" + "|".join(CONCLUSIONS))


def has_word(text: Column, words: tuple[str, ...]) -> Column:
    """Whether one of the words stands in text, letters of any script bounding them."""
    # Most texts hold none of the words even as a part of others, which is cheaper to see.
    low = F.lower(text)
    there = reduce(or_, [F.contains(low, F.lit(w.lower())) for w in words])
    return F.when(there, text.rlike(r"(?i)(^|[^\p{L}\p{N}_])(" + "|".join(words) + r")($|[^\p{L}\p{N}_])")).otherwise(F.when(text.isNotNull(), F.lit(False)))


def first_word_of(text: Column, words: tuple[str, ...]) -> Column:
    """The first of the words, in their order, that has_word() finds, or null."""
    return F.coalesce(*[F.when(has_word(text, (w,)), F.lit(w)) for w in words])


def first_part_of(text: Column, parts: tuple[str, ...]) -> Column:
    """The first of the parts, in their order, that text holds in any case, or null."""
    low = F.lower(text)
    return F.coalesce(*[F.when(F.contains(low, F.lit(p.lower())), F.lit(p)) for p in parts])


#: Blanks as the gates strip them: Java's Unicode blanks, and the four separators of U+001C to U+001F.
SPACE = r"[\s\x1c-\x1f]"


def stripped(text: Column) -> Column:
    """Text without blanks of any kind at its ends; null counting as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?U)^{SPACE}+|{SPACE}+$", "")


def opens_with(text: Column, words: tuple[str, ...] = OPENINGS) -> Column:
    """Whether text, without blanks at its ends, begins with one of the patterns."""
    return stripped(text).rlike("(?i)^(" + "|".join(words) + ")")


def contains_any(text: Column, parts: tuple[str, ...]) -> Column:
    low = F.lower(text)
    return F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(low, p))


def normalised(text: Column) -> Column:
    """Blanks collapsed, trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def answer_strict(text: Column) -> Column:
    """The first letter A-D that stands alone, in upper case; '' if none."""
    return F.regexp_extract(F.upper(F.trim(text)), r"(?:^|[^\p{L}\p{N}_])([ABCD])(?:$|[^\p{L}\p{N}_])", 1)


def answer_lax(text: Column) -> Column:
    """The first of the letters A-D anywhere."""
    return F.regexp_extract(F.upper(F.trim(text)), "[ABCD]", 0)


def answer_last(text: Column) -> Column:
    """The letter after the first final answer, or answer, named in the last ten lines; else after the last one named
    anywhere, of the first kind there is; else the last letter A-D that stands alone; '' if none (T19)."""
    lines = F.split(F.trim(text), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", -1)
    tail = F.array_join(F.slice(lines, F.greatest(F.size(lines) - 9, F.lit(1)), F.lit(10)), "\n")
    named = [rf"(?iU){word}\s*[:：]\s*([ABCD])" for word in ("最终答案", "答案")]
    blank = lambda c: F.nullif(c, F.lit(""))
    last = lambda c, p: F.try_element_at(F.regexp_extract_all(c, F.lit(p), F.lit(1)), F.lit(-1))
    alone = r"(?i)(?:^|[^\p{L}\p{N}_])([ABCD])(?=$|[^\p{L}\p{N}_])"
    return F.upper(F.coalesce(*[blank(F.regexp_extract(tail, p, 1)) for p in named], *[last(text, p) for p in (*named, alone)], F.lit("")))


def file_name(text: Column) -> Column:
    """Letters, digits, - and _ stay, others become _; 80 characters."""
    return F.substring(F.regexp_replace(text, r"[^\p{L}\p{N}_-]", "_"), 1, 80)


def final_prompt(prompt: Column, suffix: str = STYLE_SUFFIX) -> Column:
    """The prompt, trimmed, with the style suffix on a line of its own; the suffix alone without one."""
    t = stripped(prompt)
    return F.when(t == "", F.lit(suffix)).otherwise(F.concat(t, F.lit("\n" + suffix)))


def rollout_detail(detail: Column) -> Column:
    """struct<wrong, correct, answers> of a detail such as 'wrong=3 correct=1 answers=A,B,D,C', or null."""
    form = r"wrong=(\d+) correct=(\d+) answers=(\S+)"
    part = lambda k: F.regexp_extract(detail, form, k)
    value = F.struct(part(1).try_cast("int").alias("wrong"), part(2).try_cast("int").alias("correct"), F.filter(F.split(part(3), ","), lambda a: a != "").alias("answers"))
    return F.when(detail.rlike(form), value)


def lenient_detail(detail: Column) -> Column:
    """struct<wrong, correct, answers> of the parts that a detail has: counts up to 5, answers of A-D; else null."""
    part = lambda form, c: F.nullif(F.regexp_extract(c, form, 1), F.lit(""))
    answers = F.filter(F.transform(F.split(part("answers=([A-D, ]+)", detail), ","), lambda a: F.trim(a)), lambda a: a != "")
    return F.struct(part("wrong=([0-5])", F.lower(detail)).try_cast("int").alias("wrong"), part("correct=([0-5])", F.lower(detail)).try_cast("int").alias("correct"), answers.alias("answers"))


def format_detail(prefix: Column, wrong: Column, correct: Column, answers: Column, wrong_first: bool = False) -> Column:
    """The detail text of a score, 500 characters at most."""
    count = lambda name, c: F.concat(F.lit(f"{name}="), F.coalesce(c, F.lit(0)).cast("string"))
    counts = [count("correct", correct), count("wrong", wrong)]
    return F.substring(F.concat_ws(" ", prefix, *(reversed(counts) if wrong_first else counts), F.concat(F.lit("answers="), F.array_join(F.coalesce(answers, F.array().cast("array<string>")), ","))), 1, 500)


def key_subject(key: Column) -> Column:
    """A key up to its module part, -M."""
    return F.substring_index(key, "-M", 1)


def key_last(key: Column) -> Column:
    """A key's last dash-separated part; the first eight characters of a key without a dash."""
    return F.when(F.contains(key, F.lit("-")), F.substring_index(key, "-", -1)).otherwise(F.substring(key, 1, 8))


def no_python(code: Column) -> Column:
    """Whether the first 600 characters of drawing code show LaTeX and nothing of Python."""
    head = F.substring(F.coalesce(code, F.lit("")), 1, 600)
    return head.rlike(LATEX_SIGNS) & ~contains_any_case(head, PYTHON_SIGNS)


def has_cjk(text: Column) -> Column:
    """Whether a CJK ideograph occurs."""
    return text.rlike("[\\u4e00-\\u9fff\\u3400-\\u4dbf]")


def plain_digits(text: Column) -> Column:
    """Digits written above or below the line as plain ones."""
    return F.translate(text, "₀₁₂₃₄₅₆₇₈₉⁰¹²³⁴⁵⁶⁷⁸⁹", "01234567890123456789")


def clamped_int(text: Column, default: int, low: int = 0, high: int | None = None) -> Column:
    """An integer setting: the default where there is none or no number, else held between low and high."""
    number = F.trim(text).try_cast("int")
    value = F.greatest(number, F.lit(low))
    return F.when(number.isNull(), F.lit(default)).otherwise(value if high is None else F.least(value, F.lit(high)))


def steps(text: Column, above: int, most: int) -> Column:
    """A comma list of integers: those above a start, held to most, ascending and once each."""
    numbers = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x).try_cast("int"))
    kept = F.filter(numbers, lambda n: n.isNotNull() & (n > above))
    return F.array_sort(F.array_distinct(F.transform(kept, lambda n: F.least(n, F.lit(most)))))


def key_module(key: Column) -> Column:
    """A key without its last dash-separated part."""
    return F.regexp_replace(key, "-[^-]*$", "")
