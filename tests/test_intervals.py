"""Leases: points within them and coverage against plain loops, and no loop in the plan."""

import random
from datetime import date, timedelta

from examlake.operators import intervals

DAY = date(1969, 12, 20)


def test_against_loops(spark):
    rng = random.Random(2)
    day = lambda n: DAY + timedelta(days=n)
    spans = [(i, rng.choice(["a", "a", "a", "b", None]), day(s := rng.randrange(60)), day(s + rng.choice([-1, 0, 1, 3, 40]))) for i in range(120)] + [(500, "a", None, day(3)), (501, "a", day(3), None), (502, "c", day(2), day(2))]
    points = [(rng.choice(["a", "b", "z", None]), day(rng.randrange(110))) for _ in range(400)] + [("a", None)] * 3 + [("b", day(7))] * 300
    a, b = spark.createDataFrame(spans, "id int, p string, s date, e date"), spark.createDataFrame(points, "p string, at date")
    want = {i: sum(q == p and t is not None and None not in (s, e) and s <= t < e for q, t in points) if p else 0 for i, p, s, e in spans}
    for width in (1, 5, 16, 1000):
        out = intervals.counted_within(a, b, "s", "e", "at", width, ["p"], ["id"])
        assert {r["id"]: r["n"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert intervals.counted_within(a.limit(0), b, "s", "e", "at", 5, ["p"], ["id"]).count() == 0

    got = {r["p"]: tuple(r)[1:] for r in intervals.coverage(a, ["p"], "s", "e").collect()}
    for p in {"a", "b", None}:
        own = [(s, e) for _, q, s, e in spans if q == p and None not in (s, e) and s < e]
        held = [sum(s <= day(n) < e for s, e in own) for n in range(130)]
        busy = "".join("x" if k else "." for k in held).strip(".")
        gaps = [g for g in busy.split("x") if g]
        assert got[p] == (len(own), busy.count("x"), len(busy.replace(".", " ").split()), max(map(len, gaps), default=0), max(held))
    assert "c" not in got
