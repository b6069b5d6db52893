"""Leaves, whole texts and truth of JSON, on odd texts and against Python's reading."""

import json

from pyspark.sql import functions as F

from examlake.functions import text as T
from examlake.functions import variants as V
from examlake.operators import contract, dashboard

TEXTS = ['{"a": [1, {"b": "x\\"y: z", "c": null}], "k:": "v:", "e": {}, "t": true, "z": 0, "d": 1.5}', "[[[]]]", '["\\u4e2d\\n", "\\\\", ""]', "3", '"s"', "null", '{"a":1}}', '{"a":1}]', '{"a":1} x', '{"a":1},{"b":2}', '{"a":1', "x", "", None]


def plain(value):
    if isinstance(value, dict | list):
        return [x for v in (value.values() if isinstance(value, dict) else value) for x in plain(v)]
    return [value]


def test_leaves(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, j string")
    got = df.select("j", F.to_json(V.whole(F.col("j"))).alias("w"), V.leaf_values(F.col("j")).alias("v"), V.leaf_strings(F.col("j")).alias("s"), V.running_text(F.col("j")).alias("r")).collect()
    for r in got:
        try:
            value = json.loads(r["j"] or "-")
        except ValueError:
            assert r["w"] is None
            continue
        assert json.loads(r["w"]) == value
        said = [x if isinstance(x, str) or x is None else json.dumps(x) for x in plain(value)]
        assert sorted(map(str, r["v"])) == sorted(map(str, said)) and r["s"] == [x for x in plain(value) if isinstance(x, str)]
        assert r["r"] == "\n".join(x if isinstance(x, str) else json.dumps(x) if x else "" for x in plain(value))
    rows = {(r["i"], r["path"]): (r["kind"], r["value"]) for r in V.leaf_rows(df, "j", ["i"]).collect()}
    assert rows[0, "$.a[1].b"] == ("STRING", 'x"y: z') and rows[0, "$.a[1].c"] == ("VOID", None) and rows[3, "$"] == ("BIGINT", "3")
    assert len(rows) == sum(len(plain(json.loads(x))) for x in TEXTS[:6]) and V.leaf_rows(df.limit(0), "j", ["i"]).count() == 0


def test_long_strings_and_deep_nesting(spark):
    long = json.dumps({"a": '\\"\n' * 200_000, "b": ["x" * 1_000_000]})
    deep = "[" * 60 + "1" + "]" * 60
    got = spark.createDataFrame([(long,), (deep,)], "j string").select(F.transform(V.leaf_values(F.col("j")), F.length).alias("n"), V.depth(F.col("j")).alias("d")).collect()
    assert [(r["n"], r["d"]) for r in got] == [([600_000, 1_000_000], 2), ([1], 60)]


def test_blanks_and_difficulties(spark):
    df = spark.createDataFrame([(" \t\n\u3000\x1cA map\u2003\r\n",), ("\n\t",), (None,)], "t string")
    assert [r[0] for r in df.select(T.stripped(F.col("t"))).collect()] == ["A map", "", ""]
    assert [r[0] for r in df.select(T.opens_with(F.concat(F.col("t"), F.lit("Map")))).collect()] == [True, True, False]
    levels = ["3", "3.7", "-0.5", '"3"', '" 4\\n"', '"3.7"', "true", "false", "null", "[3]", '{"a": 3}', '"x"']
    rows = spark.createDataFrame([(x,) for x in levels], "j string").select(contract.level(F.try_parse_json("j")).alias("n")).collect()
    assert [r["n"] for r in rows] == [3, 3, 0, 3, 4, None, 1, 0, None, None, None, None]
    records = ['{"difficulty": 0.0, "difficulty_level": 3}', '{"difficulty": false, "metadata": {"difficulty": " 2 "}}', '{"difficulty": [], "difficulty_level": {}, "metadata": {"difficulty": 5}}', '{"difficulty": 3.0}', '{"difficulty": true}', '{"difficulty": "x", "difficulty_level": 3}', "{}", "", None]
    rows = spark.createDataFrame([(x,) for x in records], "j string").select(dashboard.difficulty(F.col("j")).alias("n")).collect()
    assert [r["n"] for r in rows] == [3, 2, 5, None, None, None, None, None, None]
