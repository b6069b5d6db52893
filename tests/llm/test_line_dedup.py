"""Line dedup reads texts together: the same units as text by text, with few passes."""

import numpy as np
import pyarrow as pa
import pytest

from examlake.llm import linededup


class Held:
    """Stands for a DataFrame and keeps the function that its tasks would run."""

    def mapInArrow(self, run, schema):
        return run


def units_of(text):
    """(hash, position, words) of one text's selected units, from the docstrings alone."""
    data = (text or "").encode()
    starts, _, h = linededup.words(data)
    each, out = linededup.lines(h).tolist(), []
    width = min(linededup.WINDOW, len(each))
    least = sorted({min(range(a, a + width), key=lambda k: (each[k], k)) for a in range(len(each) - width + 1)}) if each else []
    for k, p in enumerate(least):
        begin = next(q for q in reversed(least[: k + 1]) if q - 1 not in least or each[q - 1] != each[q])
        if (p - begin) % width == 0 or p + 1 not in least or each[p + 1] != each[p]:
            out.append((each[p], p, linededup.LINE))
    at = 0
    for line in data.split(b"\n"):
        n = len(linededup.words(line)[2])
        if linededup.SHORT <= n < linededup.LINE + linededup.WINDOW - 1:
            out.append((int(linededup.units(h, np.array([at]), np.array([at + n]))[0]), at, n))
        at += n
    return out


def texts():
    rng = np.random.default_rng(3)
    out = [None, "", " \n ", "x" * 5000, "x " * 300, "a b c d e f g h", " ".join("ab" * 60) + "\n" + " ".join("ab" * 60)]
    for _ in range(500):
        n, kinds = int(rng.integers(0, 130)), int(rng.choice([1, 2, 50_000]))
        out.append("".join(f"é{x}{s}" for x, s in zip(rng.integers(0, kinds, n), rng.choice([" ", "\n", " \t", "\r\n\n"], n, p=[0.91, 0.04, 0.03, 0.02]), strict=True)))
    return out


@pytest.mark.parametrize(("chunk", "step"), [(None, None), (700, 64), (1, 1)])
def test_texts_read_together(monkeypatch, chunk, step):
    docs, calls, words = texts(), [], linededup.words
    want = sorted((i - 9, *u) for i, t in enumerate(docs) for u in units_of(t))
    if chunk:
        monkeypatch.setattr(linededup, "CHUNK", chunk)
        monkeypatch.setattr(linededup, "STEP", step)
    monkeypatch.setattr(linededup, "words", lambda data: calls.append(len(data)) or words(data))
    batch = pa.record_batch([pa.array(np.arange(len(docs)) - 9), pa.array(docs)], names=["id", "text"])
    got = [(r["id"], r["h"] % 2**64, r["pos"], r["n"]) for b in linededup.selected(Held())(iter([batch])) for r in b.to_pylist()]
    assert sorted(got) == want
    assert chunk or len(calls) <= 2  # one pass for each 256 texts, not one for each text


def test_texts_pass_python_once(spark):
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(1, line), (2, "new " + line + " end"), (3, None), (4, "é " + line + "\n")]
    out = linededup.digest(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = {r["doc_id"]: (r["removed_words"], r["removed"], r["text_sha256"]) for r in out.collect()}
    sha = lambda t: linededup.hashlib.sha256(t.encode()).hexdigest()
    assert got == {1: (0, "", sha(line)), 2: (60, "1:61", sha("new end")), 3: (0, "", sha("")), 4: (60, "1:61", sha("é "))}
