"""Operators against hand-made rows and the vectors of the survey."""

from pyspark.sql import functions as F

from examlake.functions import text as T
from examlake.operators import gates, progress, rollouts, state
from examlake.sources import tables
from examlake.streaming import jobs


def test_rollouts(spark):
    runs = {"aaaaa": "AAAAA", "mixed": "ABDCD", "right": "DDADB"}
    rows = [(k, i, a, "D") for k, v in runs.items() for i, a in enumerate(v)]
    rows += [("tech", i, a, "D") for i, a in enumerate(["A", "", "D", "", "B"])] + [("gap", i, a, "D") for i, a in enumerate(["A", "B", "", "C"])]
    df = spark.createDataFrame(rows, "item string, idx int, answer string, key string")
    got = {r["item"]: (r["calls"], r["wrong_count"], r["correct_count"], r["decision"]) for r in rollouts.early_stopped(df).collect()}
    assert got["aaaaa"] == (3, 3, 0, "PASS") and got["mixed"] == (4, 3, 1, "PASS") and got["right"] == (4, 1, 3, "FAIL")
    assert got["tech"][3] == "TECH_FAIL" and got["gap"] == (4, 3, 0, "TECH_FAIL")
    full = {r["item"]: r["decision"] for r in rollouts.full(df).collect()}
    assert full["mixed"] == "PASS" and full["right"] == "FAIL" and full["tech"] == "TECH_FAIL"


def test_apportioned(spark):
    cases = [(10, [1, 1], [5, 5]), (5, [3, 1, 1], [2, 2, 1]), (2, [5, 5, 5], [1, 1, 0]), (0, [1, 2], [0, 0])]
    for total, weights, want in cases:
        df = spark.createDataFrame([(1, i, w) for i, w in enumerate(weights)], "g int, i int, w long")
        got = progress.apportioned(df, ["g"], F.lit(total), "w", "i").orderBy("i").collect()
        assert [r["share"] for r in got] == want


def test_answers_and_gates(spark):
    texts = ["A or B", "final: B", "a cat", "BAD", "选A项", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    strict = [r[0] for r in df.select(T.answer_strict(F.col("t"))).collect()]
    assert strict == ["A", "B", "A", "", "", ""]
    bad = spark.createDataFrame([("",), ("[1]",), ("{\"a\": 1}",), ("{\"a\": \"x \\( y\"}".replace("\\", "\\\\"),)], "j string")
    assert [r["reasons"] for r in gates.quarantine(bad, "j").collect()] == [["empty_question_json"], ["invalid_question_json_type:list"], [], ["unbalanced_latex_inline_delimiter"]]
    words = spark.createDataFrame([("one 中文字 two",), ("",), (None,)], "t string")
    assert [r[0] for r in words.select(T.mixed_words(F.col("t"))).collect()] == [3, 0, 0]


def test_state_and_sources(spark):
    df = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, "x"), (1, 3, "b", None)], "k int, o int, p string, q string")
    row = state.partial_updates(df, "k", "o", ["p", "q"]).first()
    assert (row["p"], row["q"]) == ("b", "x")
    assert state.latest(df, "k", "o", ["p", "q"]).first()["q"] is None
    assert [r[0] for r in spark.createDataFrame([("3.7",), ("x",), (None,)], "s string").select(tables.lenient_int(F.col("s"))).collect()] == [3, 0, 0]


def test_streams(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{i:02d}:00", "k", "error" if i < 4 else "ok", 1.0) for i in range(6)]
    df = spark.createDataFrame(rows, "event_id long, ts string, key string, kind string, value double").withColumn("ts", F.to_timestamp("ts"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = jobs.event_stream(spark, str(tmp_path / "in"))
    jobs.run_available(jobs.exactly_once(stream), str(tmp_path / "out"), str(tmp_path / "c1"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
    q = jobs.provider_health(stream).writeStream.outputMode("update").format("memory").queryName("health").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c2")).start()
    q.awaitTermination()
    assert spark.table("health").first()["status"] == "DEGRADED"  # two successes of six do not heal


def test_provider_states():
    def after(calls, state=jobs.FRESH):
        for ts, ok in calls:
            state = jobs.advanced(state, ts, ok)
        return state

    errors = lambda n: [(float(i), False) for i in range(n)]
    assert [after(errors(n))[3] for n in (2, 3, 4, 5, 14, 15)] == ["HEALTHY", "DEGRADED", "DEGRADED", "COOLDOWN", "COOLDOWN", "DISABLED"]
    assert after([(0.0, True)] * 100 + errors(3) + [(9.0, True)])[3] == "HEALTHY" and after(errors(3) + [(9.0, True)])[3] == "DEGRADED"
    assert after([*errors(5), (30.0, True)])[3] == "COOLDOWN" and after([*errors(5), (70.0, True)])[3] == "HEALTHY" and after([*errors(5), (70.0, False)])[:4] == (1, 0, 6, "HEALTHY")
