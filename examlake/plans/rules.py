"""Queries for text checks, parsers and gates (T, G, N, P14, P15, I), over literal texts dealt to the rows of a table:
the driver's texts hold no LaTeX, no CJK and no records."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from examlake.functions import parse as P
from examlake.functions import text as T
from examlake.operators import contract, gates, pixels
from examlake.plans.registry import NOT_WORD, query
from examlake.sources.tables import display_name, lenient_int, load


def literals(values: list) -> str:
    """The n-th of the values for row n of part, as SQL."""
    quoted = ["NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values]
    return f"[{', '.join(quoted)}][1 + p_partkey % {len(values)}]"


def dealt(values: list) -> Column:
    """The same in Spark."""
    n = F.pmod("p_partkey", F.lit(len(values))) + 1
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), n.cast("int"))


TEXTS = ["costs $5", "a\x01b", "open $$x", "$$x$$ and $y$", "\\( x", "no sign \\)", "\\frac x \\)", "a \\[ x \\]", "\\begin{a}x\\end{a}", "\\begin{a}x\\end{b}", "a rac{1}", "\\FARC{2}", "plain", "", "\\alpha and \\\\beta", "cos \\\\sum", "\\]"]
#: How often each mark occurs in t, as SQL.
DOLLARS, DOUBLED, *BRACKETS = (f"(length(t) - length(replace(t, '{part}', ''))) // {len(part)}" for part in ("$", "$$", "\\(", "\\)", "\\[", "\\]"))


@query(rf"""WITH r AS (SELECT p_partkey, {literals(TEXTS)} AS t FROM part), u AS (SELECT *, {DOLLARS} % 2 <> 0 AS odd, {BRACKETS[0]} <> {BRACKETS[1]} AS inline, {BRACKETS[2]} <> {BRACKETS[3]} AS display FROM r)
            SELECT p_partkey, regexp_matches(t, '[\x00-\x08\x0b\x0c\x0e-\x1f]') AS control, CASE WHEN regexp_matches(t, '[\x00-\x08\x0b\x0c\x0e-\x1f]') THEN 'U+0001' END AS code, odd OR inline OR display AS unbalanced,
            CASE WHEN regexp_matches(t, '\\[A-Za-z(\[]|\$\$|(^|[^\\])\$') THEN array_to_string(list_filter([CASE WHEN inline THEN 'unbalanced_latex_inline_delimiter' END, CASE WHEN display THEN 'unbalanced_latex_display_delimiter' END,
              CASE WHEN {DOUBLED} % 2 <> 0 THEN 'unbalanced_latex_double_dollar' END], lambda x: x IS NOT NULL), ',') ELSE '' END AS faults,
            regexp_extract_all(t, '\\begin\{{([^{{}}]+)\}}', 1) <> regexp_extract_all(t, '\\end\{{([^{{}}]+)\}}', 1) AS environments, contains(lower(t), '\rac') OR contains(lower(t), '\farc') OR contains(lower(t), '\frc') OR regexp_matches(t, '(^|[^a-zA-Z\\])rac\{{') AS typo,
            CASE WHEN contains(t, '$') THEN '$' WHEN contains(t, '\frac') THEN '\frac' WHEN contains(t, '\alpha') THEN '\alpha' WHEN contains(t, '\beta') THEN '\beta' WHEN contains(t, '\sum') THEN '\sum' WHEN contains(t, '\begin') THEN '\begin' WHEN contains(t, '\end') THEN '\end' END AS marker,
            CASE WHEN contains(t, '$') THEN '$' WHEN contains(t, '\\beta') THEN '\\beta' WHEN contains(t, '\\sum') THEN '\\sum' END AS doubled FROM u""")
def latex_texts(spark, d):
    t = F.col("t")
    rows = load(spark, d, "part").select("p_partkey", dealt(TEXTS).alias("t"))
    return rows.select("p_partkey", T.control_chars(t).alias("control"), T.first_control(t).alias("code"), T.unbalanced(t).alias("unbalanced"), F.array_join(T.latex_faults(t), ",").alias("faults"), T.environments_differ(t).alias("environments"), T.typo(t).alias("typo"), T.raw_marker(t).alias("marker"), T.doubled_marker(t).alias("doubled"))


PROMPTS = ["A bar chart", "  diagram of several parts", "Picture with a few lines", "Tree with no SHADING", "axis", "", "An awesome plot, textbook Illustration", "line with Various multiple marks", "A\tmap"]


@query(rf"""WITH r AS (SELECT p_partkey, {literals(PROMPTS)} AS t FROM part)
            SELECT p_partkey, regexp_matches(trim(t), '(?i)^(A\s|An\s|Diagram|Chart|Graph|Engineering|Technical|Scientific|Physics|Chemical|Biological|Mechanical|Electrical|Circuit|Structure|Cross-section|Flowchart|Table|Plot|Map|Schematic|Venn|Bar|Scatter|Line|Histogram|Tree|Network)') AS opens,
            CASE WHEN contains(lower(t), 'textbook illustration') THEN 'textbook illustration' WHEN contains(lower(t), 'no shading') THEN 'no shading' END AS suffix,
            CASE WHEN regexp_matches(t, '(?i)(^|{NOT_WORD})several($|{NOT_WORD})') THEN 'several' WHEN regexp_matches(t, '(?i)(^|{NOT_WORD})some($|{NOT_WORD})') THEN 'some' WHEN regexp_matches(t, '(?i)(^|{NOT_WORD})a few($|{NOT_WORD})') THEN 'a few'
              WHEN regexp_matches(t, '(?i)(^|{NOT_WORD})various($|{NOT_WORD})') THEN 'various' WHEN regexp_matches(t, '(?i)(^|{NOT_WORD})multiple($|{NOT_WORD})') THEN 'multiple' END AS vague,
            CASE WHEN trim(t) = '' THEN '' ELSE trim(t) || chr(10) END || '{T.STYLE_SUFFIX}' AS final FROM r""")
def prompt_rules(spark, d):
    t = F.col("t")
    rows = load(spark, d, "part").select("p_partkey", dealt(PROMPTS).alias("t"))
    return rows.select("p_partkey", T.opens_with(t).alias("opens"), T.first_part_of(t, T.SUFFIX_WORDS).alias("suffix"), T.first_word_of(t, T.VAGUE_WORDS).alias("vague"), T.final_prompt(t).alias("final"))


SAID = ["The  answer\nIS b", "option c correct", "Total Cost is 3", "the best one", "正确答案", "minimal", "bestow", "path total", "min", "最终排序 x", "total cost of 3", "最大值"]


@query(f"SELECT p_partkey, {literals(['y', 'y', 'y', 'y', 'y', 'n', 'n', 'y', 'y', 'y', 'n', 'y'])} = 'y' AS concludes, lower(trim(regexp_replace(t, '\\s+', ' ', 'g'))) AS plain FROM (SELECT p_partkey, {literals(SAID)} AS t FROM part)")
def conclusions(spark, d):
    rows = load(spark, d, "part").select("p_partkey", dealt(SAID).alias("t"))
    return rows.select("p_partkey", T.concludes(F.col("t")).alias("concludes"), T.normalised(F.col("t")).alias("plain"))


#: An answer's text, and what the strict, the lax and the last-match reader make of it.
ANSWERS = [
    ('{"answer":"A"}', "A", "A", "A"), ('<think>B</think>{"answer":"C"}', "C", "C", "C"), ("BAD", "", "", ""), ("选A项", "", "", ""), ("最终答案：B", "B", "B", "B"), ("a cat", "A", "A", "A"),
    ("A or B", "A", "", "B"), ('x {"answer": {"b": 1}} answer: d', "B", "D", "D"), ('{"answer": ""}', "", "", ""), ("答案: c\nthen A", "C", "C", "C"), ("", "", "", ""), ('{"k": 1} B', "B", "B", "B"),
]


@query(f"SELECT p_partkey, {literals([a[1] for a in ANSWERS])} AS strict, {literals([a[2] for a in ANSWERS])} AS lax, {literals([a[3] for a in ANSWERS])} AS last FROM part")
def answer_parsers(spark, d):
    t = F.col("t")
    rows = load(spark, d, "part").select("p_partkey", dealt([a[0] for a in ANSWERS]).alias("t"))
    return rows.select("p_partkey", P.answer_of(t).alias("strict"), P.answer_of(t, lax=True).alias("lax"), T.answer_last(t).alias("last"))


#: A model's text, the rung that reads it, its first balanced object and array.
DRAFTS = [
    ('```json\n[{"question_text": 1}]\n```', "fenced", '{"question_text": 1}', '[{"question_text": 1}]'), ('so [{"question_text": "]"}] ok', "brackets", '{"question_text": "]"}', '[{"question_text": "]"}]'),
    ("[]", "brackets", None, "[]"), ('[{"question_text": 2},]', "commas", '{"question_text": 2}', '[{"question_text": 2},]'), ('[{"other": 2}]', None, '{"other": 2}', '[{"other": 2}]'), ("none", None, None, None), ('{"a": {"b": 1}', None, None, None),
]


@query(f"SELECT p_partkey, {literals([x[1] for x in DRAFTS])} AS rung, {literals([x[2] for x in DRAFTS])} AS first_object, {literals([x[3] for x in DRAFTS])} AS first_array FROM part")
def json_recovery(spark, d):
    rows = load(spark, d, "part").select("p_partkey", dealt([x[0] for x in DRAFTS]).alias("t"))
    return rows.select("p_partkey", P.recovered(F.col("t")).alias("r"), P.spans(F.col("t")).alias("s")).select("p_partkey", "r.rung", F.col("s.object").alias("first_object"), F.col("s.array").alias("first_array"))


#: LaTeX, commands outside math, commands without their arguments, and how it is drawn.
FORMULAS = [
    ("$\\frac{1}{2}$", None, "", "1/2"), ("so \\frac{1}{2\\sqrt{y}}", "\\frac", "", "so \\frac{1}{2\\sqrt{y}}"), ("$\\sqrt[3]{8}$ and $\\binom{2}$", None, "binom", "√[3]8 and \\binom2".replace("\\", "")),
    ("$\\vec{B}$ in", None, "", "B→ in"), ("$x^2 + y_1$", None, "", "x² + y₁"), ("\\frac{1", "\\frac", "frac", "\\frac{1"), ("\\(\\alpha\\) \\beta", "\\beta", "", "\\(\\alpha\\) \\beta"), ("$\\Delta T = \\left(\\pi\\right)$", None, "", "Δ T = (π)"), ("", None, "", ""),
]


@query(f"SELECT p_partkey, {literals([x[1] for x in FORMULAS])} AS bare, {literals([x[2] for x in FORMULAS])} AS incomplete, {literals([x[3] for x in FORMULAS])} AS drawn FROM part")
def formulas(spark, d):
    t = F.col("t")
    rows = load(spark, d, "part").select("p_partkey", dealt([x[0] for x in FORMULAS]).alias("t"))
    return rows.select("p_partkey", T.bare_command(t).alias("bare"), F.array_join(P.incomplete_commands(t), ",").alias("incomplete"), P.unicode_math(t).alias("drawn"))


CODE = ["import x\n\\draw", "\\begin{tikzpicture}", "\\documentclass{a}", "plt.plot()", "", "\\draw (0,0)", "x = 1"]
SETTINGS = ["5", " 12 ", "x", "", "-3", "700", None]


@query(f"""SELECT p_partkey, {literals(['n', 'y', 'y', 'n', 'n', 'y', 'n'])} = 'y' AS no_python, {literals(['5', '12', '9', '9', '0', '100', '9'])}::INTEGER AS held, {literals(['n', 'y', 'n', 'y', 'n', 'n', 'n'])} = 'y' AS cjk, 'x12' AS plain,
           {literals(['3', '0', '0', '0', '-2', '1', '0'])}::INTEGER AS lenient, {literals(['zh', 'plain', 'n', 'e', 'text', '', 'q'])} AS shown FROM part""")
def small_parsers(spark, d):
    rows = load(spark, d, "part").select("p_partkey", dealt(CODE).alias("code"), dealt(SETTINGS).alias("s"), dealt(["a", "中", "é", "㐀b", "1", "", "x"]).alias("c"), dealt(["3.7", "x", None, "", "-2", "1e0", "nan"]).alias("n"), dealt(['{"zh": "zh", "en": "e"}', "plain", '{"name": "n"}', '{"en": "e"}', '"text"', "", "q"]).alias("m"))
    number = F.when(F.lower("n") == "nan", "0").otherwise(F.col("n"))
    return rows.select("p_partkey", T.no_python(F.col("code")).alias("no_python"), T.clamped_int(F.col("s"), 9, 0, 100).alias("held"), T.has_cjk(F.col("c")).alias("cjk"), T.plain_digits(F.lit("x¹₂")).alias("plain"), lenient_int(number).alias("lenient"), F.coalesce(display_name(F.col("m")), F.lit("")).alias("shown"))


#: Questions before review: what is changed in a good one, and the issues that brings.
PROMPT = "Diagram of a circuit with " + " ".join(f"part{i} at x{i}" for i in range(20))
GOOD = {"question_text": "Which $x$ is it?", "explanation": "It is $\\frac{1}{2}$.", "correct_answer": "B", "question_language": "zh", "image_prompt": PROMPT, "a": "1", "b": "2", "c": "3", "d": "4"}
CHANGES = [
    ({}, ""), ({"image_prompt": "  "}, "prompt_empty"), ({"image_prompt": "Sketch of some $x$"}, "prompt_short,prompt_opening,prompt_vague,prompt_latex,image_prompt:raw_latex"), ({"explanation": ""}, "missing_explanation"), ({"question_language": "fr"}, "language"),
    ({"correct_answer": "E"}, "answer"), ({"question_text": "Is \\frac{1} $ it?"}, "question_text:dollar,question_text:arguments_frac,question_text:bare_command"), ({"c": "\\begin{a}"}, "options.C:environments"), ({"image_prompt": PROMPT + " with no gradients"}, "prompt_suffix"), ({"image_prompt": "\n\t" + PROMPT}, ""),
]


@query(f"SELECT p_partkey, {literals([x[1] for x in CHANGES])} AS issues, {literals([x[1] for x in CHANGES])} = '' AS passed FROM part")
def pre_validation(spark, d):
    rows = load(spark, d, "part").select("p_partkey", *[dealt([(GOOD | x[0])[k] for x in CHANGES]).alias(k) for k in GOOD])
    options = F.create_map(*[c for k in "abcd" for c in (F.lit(k.upper()), F.col(k))])
    out = gates.pre_validated(rows.withColumn("options", options))
    return out.select("p_partkey", F.array_join("issues", ",").alias("issues"), "passed")


#: Generated questions: what is changed in a good one, and the reason it fails for.
CONTRACT = {"version": "1", "diagram_type": "graph", "visual_facts": ["edge A to C has weight 4"], "answer_relevant_facts": ["edge C to D has weight 2"], "labels": ["A", "C", "D"], "quantities": {"AC": 4}, "relations": ["A-C"], "constraints": ["directed"], "distractor_rationales": {k: "r" for k in "ABCD"}, "qwen36_difficulty_rationale": "two steps", "forbidden_text_leakage": ["weight 4 on A to C"]}
QUESTION = {"question_text": "Which way from A to D?", "options": {"A": "1", "B": "2", "C": "3", "D": "4"}, "correct_answer": "B", "explanation": "x", "difficulty": 3, "question_language": "zh", "image_contract": CONTRACT, "image_prompt": PROMPT, "image_dependency_reason": "needs it"}
DRAFT_CHANGES = [
    ({}, {}, None), ({"image_contract": None}, {}, "missing_image_contract"), ({}, {"relations": None}, "contract"), ({"question_text": "Which? weight 4 on  A to C"}, {}, "text_leak"), ({}, {"answer_relevant_facts": ["Its best route goes by C."]}, "answer_given"),
    ({}, {"distractor_rationales": {"A": "r"}}, "contract"), ({"render_code": "x"}, {}, "old_render_code"), ({"options": {"A": "1", "B": "1", "C": "3", "D": "4"}}, {}, "options_alike"), ({"correct_answer": "b"}, {}, "answer"), ({"question_language": "de"}, {}, "language"), ({"difficulty": 9}, {}, "difficulty"),
    ({"image_prompt": "A map"}, {}, "prompt_length"), ({"image_prompt": "Sketch" + PROMPT[7:]}, {}, "prompt_opening"), ({"difficulty": 0}, {}, "missing_difficulty"), ({}, {"quantities": "4"}, "contract"),
    ({}, {"quantities": {"max": 4}}, None), ({}, {"quantities": {"of": [{"which": "the max"}]}}, "answer_given"), ({"difficulty": "3.7"}, {}, "difficulty"), ({"difficulty": 3.7}, {}, None), ({"difficulty": True}, {}, None), ({"difficulty": " 2\t"}, {}, None), ({"difficulty": 0.5}, {}, "difficulty"),
    ({"image_prompt": "\n\t" + PROMPT + "\u3000"}, {}, None), ({"options": {"A": "1", "B": "1\t", "C": "3", "D": "4"}}, {}, "options_alike"), ({}, {"version": "\n"}, "contract"),
]


def changed(question: dict, contract_: dict) -> str:
    whole = {**QUESTION, "image_contract": {k: v for k, v in {**CONTRACT, **contract_}.items() if v is not None}, **question}
    return json.dumps({k: v for k, v in whole.items() if v is not None}, ensure_ascii=False)


#: Drafts and their reasons; the last ones are no single object.
QUESTIONS = [(changed(*x[:2]), x[2]) for x in DRAFT_CHANGES] + [(changed({}, {}) + rest, "no_json") for rest in ("}", "]", " x", ", {}")] + [("[1]", "no_json"), (None, "no_json")]


@query(f"SELECT p_partkey, {literals([x[1] for x in QUESTIONS])} AS reason, {literals([x[1] for x in QUESTIONS])} IS NULL AS passed FROM part")
def question_contract(spark, d):
    rows = load(spark, d, "part").select("p_partkey", dealt([x[0] for x in QUESTIONS]).alias("q"))
    return contract.question_gate(rows, "q").select("p_partkey", "reason", "passed")


@query("""SELECT event_id, CASE WHEN event_id % 7 = 0 OR user_id % 10 = 4 THEN 'skip' WHEN event_id % 7 = 1 THEN 'hold' WHEN event_type IN ('error', 'view') THEN 'image' WHEN event_type = 'click' THEN 'review'
          WHEN event_type = 'signup' THEN CASE WHEN event_id % 7 = 2 THEN 'review' ELSE 'regen' END ELSE 'skip' END AS route FROM events""")
def recycle_triage(spark, d):
    t, n = F.col("event_type"), F.col("event_id") % 7
    status = F.when(t == "error", "RENDER_FAIL").when(t == "view", "ACCEPTED").when(t == "click", "GENERATED").when(t == "signup", "HOLD").otherwise("FINAL_PASS")
    detail = F.when(n == 0, "recycle_quarantine: x").when(n == 2, "HTTP timeout").otherwise("quality")
    rows = load(spark, d, "events").select("event_id", status.alias("quality_status"), F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("subject_id"), detail.alias("last_audit_detail"), F.lit("").alias("sentinel_result"), F.when(n == 1, "[1]").otherwise('{"question_text": "x"}').alias("j"))
    return gates.triaged(rows, "j", ("S4",)).select("event_id", "route")


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'PASS' WHEN 2 THEN 'PASS' ELSE 'FAIL' END AS decision, array_to_string(list_filter([CASE WHEN event_id % 3 = 0 THEN 'answer' END, CASE WHEN event_id % 5 = 0 THEN 'scope' END,
          CASE WHEN event_id % 3 <> 0 AND event_id % 5 <> 0 AND event_id % 2 = 0 THEN 'review_failed' END], lambda x: x IS NOT NULL), ',') AS kinds FROM events""")
def review_decisions(spark, d):
    n = F.col("event_id")
    said = gates.reviewed(F.when(n % 4 == 0, "pass").when(n % 4 == 1, "maybe").when(n % 4 == 2, ""), F.when(n % 4 == 2, "Pass"))
    kinds = gates.failure_kinds({"answer_correct": n % 3 != 0, "options_reasonable": F.lit(None).cast("boolean"), "scope_correct": n % 5 != 0}, F.when(n % 2 == 0, 1).otherwise(0))
    return load(spark, d, "events").select("event_id", said.alias("decision"), F.array_join(kinds, ",").alias("kinds"))


ENGINES = [("venn", "venn_2sets", None), (" Graph ", "tree", None), ("graph", "pie", "kind"), ("matplotlib", "other", None), ("unknown", "x", None), ("", "x", "no_engine"), (None, None, "no_engine"), ("fallback", "x", None), ("circuit", None, "kind")]
INSTRUCTIONS = [('{"render_instruction": {"engine": "venn"}}', "venn"), ('{"render_instruction": "{\\"engine\\": \\"map\\"}"}', "map"), ('{"render_code": "plt.x()"}', "fallback"), ('{"render_instruction": "no"}', None), ("{}", None)]


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 11 = 10 AND {literals(['y' if e[2] != 'no_engine' else 'n' for e in ENGINES])} = 'y' THEN 'no_data' ELSE {literals([e[2] for e in ENGINES])} END AS fault, {literals([i[1] for i in INSTRUCTIONS])} AS engine FROM part")
def drawing_instructions(spark, d):
    rows = load(spark, d, "part").select("p_partkey", dealt([e[0] for e in ENGINES]).alias("e"), dealt([e[1] for e in ENGINES]).alias("k"), dealt([i[0] for i in INSTRUCTIONS]).alias("j"))
    plot = F.when(F.col("e") == "matplotlib", "line")
    fault = contract.instruction_fault(F.col("e"), F.col("k"), F.col("p_partkey") % 11 != 10, plot)
    return rows.select("p_partkey", fault.alias("fault"), F.get_json_object(contract.instruction(F.col("j")), "$.engine").alias("engine"))


#: Pictures by the row's number, their file size, and what the gates say.
PICTURES = [("white", 9000, "white,flat,empty,no_content,few_colours,small_file,smooth"), ("noise", 90000, "few_colours,noise"), ("box", 90000, "few_colours,smooth"), ("small", 1000, "too_small"), ("none", 5000, "no_image")]


def picture(name: str) -> bytes:
    import numpy as np

    a = np.full((520, 520, 3), 255, np.uint8)
    if name == "noise":
        a = np.random.default_rng(1).integers(0, 2, (520, 520, 1), np.uint8).repeat(3, axis=2) * 255
    if name == "box":
        a[150:370, 150:370] = 0
    return a.tobytes()


@query(f"SELECT r_regionkey, [{', '.join(repr(p[2]) for p in PICTURES)}][1 + r_regionkey % 5] AS issues, false AS passed FROM region")
def pixel_gate(spark, d):
    @F.pandas_udf("binary")
    def drawn(names: pd.Series) -> pd.Series:
        return names.map(lambda n: None if n == "none" else picture(n))

    pick = lambda k, t: F.element_at(F.array(*[F.lit(p[k]) for p in PICTURES]), F.pmod("r_regionkey", F.lit(5)) + 1).cast(t)
    rows = load(spark, d, "region").select("r_regionkey", drawn(pick(0, "string")).alias("pixels"), pick(1, "long").alias("size"), *[F.lit(None).cast("string").alias(c) for c in ("engine", "plot_type")], F.lit("image_prompt").alias("diagram_type"))
    rows = rows.withColumns({c: F.when(F.col("pixels").isNotNull(), n) for c, n in (("height", 520), ("width", 520), ("channels", 3))})
    return pixels.pixel_gate(rows).select("r_regionkey", F.array_join("issues", ",").alias("issues"), "passed")
