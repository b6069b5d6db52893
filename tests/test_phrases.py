"""Phrases in texts: both routes against a plain search, and time linear in a text's length."""

import random
import time

import pytest

from examlake.operators import phrases

LETTERS = "ab é\U0001f600"


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(4)
    draw = lambda n: "".join(rng.choice(LETTERS) for _ in range(n))
    texts = [(i, draw(rng.choice([0, 7, 8, 40, 400]))) for i in range(120)] + [(120, None), (None, "aaaaaaaaaaaaaa"), (121, "a" * 3000), (121, "again the same id aaaaaaaaaa")]
    found = [(f"p{i}", t[j : j + rng.choice([7, 8, 9, 30])]) for i, (_, t) in enumerate(texts[:60]) if t and len(t) > 40 for j in [rng.randrange(len(t) - 35)]]
    known = [*found, ("q", "a" * 8), ("r", "a" * 20), ("r", "never there at all"), ("s", None), (None, "aaaaaaaaaa"), ("short", "aa"), ("q", "a" * 8)]
    return texts, known


@pytest.mark.parametrize("carried", [phrases.CARRIED, 0])
def test_both_routes(spark, cases, carried):
    texts, known = cases
    want = sorted({(i, k) for i, t in texts for k, p in known if i is not None and k is not None and t and p and len(p) >= 8 and p in t})
    a = spark.createDataFrame([(i, t, "x") for i, t in texts], "id int, t string, gram string").repartition(3)
    b = spark.createDataFrame([(k, p, 1) for k, p in known], "name string, p string, at int").repartition(2)
    got = sorted(tuple(r) for r in phrases.leaks(a, b, "t", "p", "id", "name", carried=carried).collect())
    assert got == want and len(want) > 9
    assert phrases.leaks(a, b.limit(0), "t", "p", "id", "name", carried=carried).count() == 0
    assert phrases.leaks(a.limit(0), b, "t", "p", "id", "name", carried=carried).count() == 0


def test_time_is_linear():
    rng = random.Random(1)
    words = [f"word{rng.randrange(500)}" for _ in range(400_000)]
    wanted = [" ".join(words[i : i + 6]) for i in range(0, 4000, 40)]
    import numpy as np

    held = sorted((int(phrases.gram_hashes(p)[0]), p) for p in wanted)
    grams, at, known = np.array([g for g, _ in held]), [0] * len(held), [p for _, p in held]

    def seconds(n):
        text, best = " ".join(words[:n]), 9.0
        for _ in range(3):
            t = time.perf_counter()
            assert len(phrases.met(text, grams, at, known)) == len(known)
            best = min(best, time.perf_counter() - t)
        return best

    assert seconds(400_000) < 3 * 2 * seconds(200_000)
