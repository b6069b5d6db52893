"""The quarantine gate's LaTeX rule, on records as the survey states it."""

import json

from examlake.operators import gates


def test_latex_of_records(spark):
    cases = [("costs $5", []), ("open $$x", ["unbalanced_latex_double_dollar"]), ("$$x$$", []), ("x \\( y", ["unbalanced_latex_inline_delimiter"]), ("lone \\)", []), ("\\frac \\)", ["unbalanced_latex_inline_delimiter"])]
    rows = [(json.dumps({"question_text": t, "note": "$$"}), want) for t, want in cases]
    rows += [(json.dumps({"options": {"A": ["fine", {"x": "$$1"}]}}), ["unbalanced_latex_double_dollar"]), (json.dumps({"truth_spec": "a", "id": "\\("}), []), ("<p>$$</p>", ["json_parse_error"]), ("{}}", ["json_parse_error"])]
    df = spark.createDataFrame(rows, "j string, want array<string>")
    got = gates.quarantine(df, "j").collect()
    assert [r["reasons"] for r in got] == [r["want"] for r in got]
