"""Composite checks that explain themselves: arrays of issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examlake.functions import parse as P
from examlake.functions import text as T


def issues(checks: dict[str, Column]) -> Column:
    """Names of the checks that hold, in order."""
    return F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks.items()]), lambda x: x.isNotNull())


def prompt_gate(rows: DataFrame, text: str, least: int = 50, most: int = 200, vague: tuple[str, ...] = T.VAGUE_WORDS) -> DataFrame:
    """issues and passed of each text: empty, too short or long, unbalanced, control characters, vague words (the part
    of G1 that any prompt can be put to). Words are counted once a row."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = issues({"empty": T.stripped(t) == "", "too_short": F.col("_words") < least, "too_long": F.col("_words") > most, "unbalanced_math": T.unbalanced(t), "control_char": T.control_chars(t), "vague_word": T.has_word(t, vague)})
    return rows.withColumn("_words", T.mixed_words(t)).withColumn("issues", found).drop("_words").withColumn("passed", F.size("issues") == 0)


def latex_checks(text: Column) -> dict[str, Column]:
    """The checks of one text field, by name, in order."""
    odd = T.occurrences(text, "$") % 2 != 0
    uneven = lambda a, b: T.occurrences(text, a) != T.occurrences(text, b)
    out = {"control_char": T.control_chars(text), "dollar": odd, "inline_delimiter": uneven("\\(", "\\)"), "display_delimiter": uneven("\\[", "\\]")}
    broken = P.incomplete_commands(text)
    out |= {f"arguments_{c}": F.array_contains(broken, c) for c in P.ARGUMENTS}
    return out | {"environments": T.environments_differ(text), "typo": T.typo(text), "bare_command": T.bare_command(text).isNotNull()}


def latex_gate(rows: DataFrame, fields: list[str], prompt: str) -> DataFrame:
    """issues of each row: name:check of its text fields, in their order, then of the drawing prompt.

    Null and empty fields are passed over.
    """
    found = {f"{f}:{name}": check for f in fields for name, check in latex_checks(F.col(f)).items()}
    found |= {f"{prompt}:control_char": T.control_chars(F.col(prompt)), f"{prompt}:raw_latex": T.raw_marker(F.col(prompt)).isNotNull()}
    return rows.withColumn("issues", issues(found))


def missing(fields: dict[str, Column]) -> Column:
    """Names of the fields that are null, empty, or hold nothing (P11, X8 without zero)."""
    return issues(fields)


#: Options of a question, and languages it may be in.
LETTERS, LANGUAGES = ("A", "B", "C", "D"), ("zh", "en")


def pre_validated(rows: DataFrame, least: int = 50, most: int = 200) -> DataFrame:
    """issues and passed of questions before review (G1): the prompt's length, suffix words, opening, vague words and
    raw LaTeX; required fields, language, options and answer; then the LaTeX gate over the texts. An empty prompt is
    the only issue of its row.

    rows: question_text, explanation, correct_answer, question_language, image_prompt strings; options map<string,string>.
    """
    p, options = F.coalesce("image_prompt", F.lit("")), F.col("options")
    there = F.coalesce(F.size(options) > 0, F.lit(False))
    found = {"prompt_short": F.col("_words") < least, "prompt_long": F.col("_words") > most, "prompt_suffix": T.first_part_of(p, T.SUFFIX_WORDS).isNotNull(), "prompt_opening": ~T.opens_with(p), "prompt_vague": T.first_word_of(p, T.VAGUE_WORDS).isNotNull(), "prompt_latex": T.raw_marker(p).isNotNull()}
    for f in ("question_text", "options", "correct_answer", "explanation", "question_language"):
        found[f"missing_{f}"] = ~there if f == "options" else F.coalesce(F.col(f), F.lit("")) == ""
    found["language"] = ~F.coalesce(F.col("question_language").isin(*LANGUAGES), F.lit(False))
    found["options_incomplete"] = there & ~has_letters(options)
    found["answer"] = there & ~F.coalesce(F.col("correct_answer").isin(*LETTERS), F.lit(False))
    texts = rows.withColumn("_words", T.mixed_words(p)).withColumns({f"_option_{k}": F.try_element_at(options, F.lit(k)) for k in LETTERS})
    fields = ["question_text", *(f"_option_{k}" for k in LETTERS), "explanation"]
    gated = latex_gate(texts, fields, "image_prompt")
    blank = F.regexp_replace(p, r"(?U)\s+", "") == ""
    whole = F.when(blank, F.array(F.lit("prompt_empty"))).otherwise(F.concat(issues(found), F.transform("issues", lambda x: F.replace(x, F.lit("_option_"), F.lit("options.")))))
    return gated.withColumn("issues", whole).drop("_words", *(f"_option_{k}" for k in LETTERS)).withColumn("passed", F.size("issues") == 0)


def has_letters(options: Column) -> Column:
    """Whether a map has all of A-D."""
    return F.forall(F.array(*map(F.lit, LETTERS)), lambda k: F.map_contains_key(options, k))


def quarantine(rows: DataFrame, json: str) -> DataFrame:
    """reasons to hold a record back, in order: empty; control character, with its code; no JSON; no object, with its
    type; LaTeX brackets by T5 (G5)."""
    t, kind = F.coalesce(json, F.lit("")), F.col("_record.kind")
    empty = F.regexp_replace(t, r"(?U)\s+", "") == ""
    control = F.when(T.control_chars(t), F.array(F.concat(F.lit("illegal_control_char:"), T.first_control(t)))).otherwise(F.array())
    parsed = F.when(kind == "broken", F.array(F.lit("json_parse_error"))).when(kind != "object", F.array(F.concat(F.lit("invalid_question_json_type:"), kind))).otherwise(T.latex_faults(F.col("_record.text")))
    found = F.when(empty, F.array(F.lit("empty_question_json"))).otherwise(F.concat(control, parsed))
    return rows.withColumn("_record", T.record(t)).withColumn("reasons", found).drop("_record")


def recoverable(texts: list[Column]) -> Column:
    """Whether a held record names a technical fault and was not quarantined before."""
    low = F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in texts]))
    return ~F.contains(low, F.lit(T.QUARANTINED)) & T.contains_any(low, T.HOLD_MARKERS)


#: Statuses that go back to drawing, to review (with recoverable ones on hold), and to a new draft.
TO_IMAGE, TO_REVIEW, TO_REGEN = ("ACCEPTED", "RENDER_FAIL", "RENDER_FAILED"), ("GENERATED",), ("SENTINEL_REGEN", "REGENERATE", "REPAIR_PENDING", "SENTINEL_FAIL_FINAL", "HOLD")


def triaged(rows: DataFrame, json: str, skipped_subjects: tuple[str, ...] = ()) -> DataFrame:
    """route of recycled records (G6): skip if quarantined before or of a subject left out; hold, with reasons, if the
    quarantine gate finds any; else by status. rows: quality_status, subject_id, last_audit_detail, sentinel_result."""
    held = quarantine(rows, json)
    seen = F.contains(F.coalesce("last_audit_detail", F.lit("")), F.lit(T.QUARANTINED))
    back = recoverable([F.col(c) for c in ("sentinel_result", "last_audit_detail", json, "quality_status")])
    skip = F.coalesce(F.col("subject_id").isin(*skipped_subjects), F.lit(False)) if skipped_subjects else F.lit(False)
    return held.withColumn("route", F.when(seen | skip, "skip").when(F.size("reasons") > 0, "hold").otherwise(routed(F.col("quality_status"), back)))


def reviewed(decision: Column, verdict: Column) -> Column:
    """PASS or FAIL of a review: decision, or verdict if there is none, in any case; all else fails."""
    said = F.upper(F.coalesce(F.nullif(decision, F.lit("")), F.nullif(verdict, F.lit("")), F.lit("FAIL")))
    return F.when(said.isin("PASS", "FAIL"), said).otherwise("FAIL")


#: Flags of a review, and the kind of failure that a false one stands for.
FLAGS = {"answer_correct": "answer", "options_reasonable": "options", "prompt_consistent": "prompt_mismatch", "image_dependency_valid": "image_dependency", "scope_correct": "scope", "prompt_compliant": "prompt_rules"}


def failure_kinds(flags: dict[str, Column], n_issues: Column) -> Column:
    """Kinds of failure by flags that are false, in order; review_failed if there are only issues."""
    found = issues({FLAGS[f]: F.coalesce(~c, F.lit(False)) for f, c in flags.items()})
    return F.when((F.size(found) == 0) & (n_issues > 0), F.array(F.lit("review_failed"))).otherwise(found)


def routed(status: Column, recoverable: Column) -> Column:
    """Where a recycled record goes: the first rule that holds."""
    return F.when(status.isin(*TO_IMAGE), "image").when(status.isin(*TO_REVIEW) | ((status == "HOLD") & recoverable), "review").when(status.isin(*TO_REGEN), "regen").otherwise("skip")


def zone(fill: Column, bounds: tuple[float, ...] = (0.30, 0.50, 0.70, 0.80)) -> Column:
    """Band of a queue's fill: how many bounds it has reached."""
    return sum((fill >= b).cast("int") for b in bounds)


#: Difficulties in turn by importance, from the least importance on, and what they ask of a drawing.
PATTERNS = ((4.5, (3, 4, 4, 5, 3, 4, 5, 4)), (3.5, (2, 3, 3, 4, 3, 4, 2, 3)), (2.5, (2, 3, 3, 2, 4, 3, 2, 3)), (float("-inf"), (1, 2, 2, 3, 2, 3, 1, 2)))
COMPLEXITY = ("single-step reading/calculation; 3-5 main visual elements", "two-step reasoning; 4-6 main visual elements", "multi-step reasoning with one distractor relation; 5-7 main visual elements", "advanced synthesis; 6-8 main visual elements, but still visually uncluttered")


def difficulty_pattern(importance: Column) -> Column:
    """Difficulties that slots take in turn, by importance."""
    return F.coalesce(*[F.when(importance >= least, F.array(*map(F.lit, p))) for least, p in PATTERNS])


def complexity(difficulty: Column) -> Column:
    """What a drawing may hold, by difficulty."""
    return F.element_at(F.array(*map(F.lit, COMPLEXITY)), F.least(F.greatest(difficulty - 1, F.lit(1)), F.lit(4)).cast("int"))


def completed_options(options: dict[str, Column]) -> Column:
    """Four options, none blank, all different."""
    values = F.array(*[T.stripped(v) for v in options.values()])
    return (F.size(F.array_distinct(values)) == len(options)) & F.forall(values, lambda v: v != "")
