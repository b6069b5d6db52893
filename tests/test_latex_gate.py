"""Text checks and the LaTeX gate on texts that the reference's rules tell apart."""

from pyspark.sql import functions as F

from examlake.functions import text as T
from examlake.operators import gates


def test_latex_gate(spark):
    cases = [
        ("plain", "an apple", []), ("$\\frac{1}{2}$ and \\(\\alpha\\)", "α ≤ 2", []), ("so \\frac{1}{2}", "x", ["q:bare_command"]), ("$$a$$ \\[\n\\sum\n\\] $b$", "x", []),
        ("\\begin{a}\\begin{b}\\end{b}\\end{a}", "x", ["q:environments"]), ("\\begin{a}x\\end{a}", "x", []), ("open \\begin{a}", "x", ["q:environments"]), ("a rac{1}", "x", ["q:typo"]),
        ("\\FARC", "x", ["q:typo"]), ("trac{", "x", []), ("one $", "\\alpha", ["q:dollar", "p:raw_latex"]), (None, None, []), ("\x01", "$", ["q:control_char", "p:raw_latex"]),
    ]
    got = gates.latex_gate(spark.createDataFrame(cases, "q string, p string, want array<string>"), ["q"], "p").collect()
    assert [r["issues"] for r in got] == [r["want"] for r in got]
    texts = {"The  answer\nIS b": True, "option c correct": True, "total cost is 3": True, "the best": True, "正确答案": True, "minimal": False, "bestow": False, "total cost of 3": False, "": False}
    df = spark.createDataFrame(list(texts.items()), "t string, want boolean")
    assert all(r[0] == r[1] for r in df.select(T.concludes(F.col("t")), "want").collect())
