"""Quality classifier: a generalised additive model with pairwise interactions, kept as lookup tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examlake.llm.common import slices

#: Labelled rows that are fitted, at most: those least by hash. Bins of a feature, and of each side of a pair.
SAMPLE, BINS, PAIR_BINS = 20_000, 32, 8
ROUNDS, RATE, PAIRS, LEAST_LEAF = 150, 0.15, 6, 20
THRESHOLD = 0.3

FEATURES = ("log_chars", "mean_word", "distinct_words", "commonest_word", "upper", "digits", "stops", "marks", "bars", "shouts", "line_words", "distinct_lines", "long_words", "letters")


def features(text: str | None) -> list[float]:
    """Shares and lengths of one text; null and empty texts give zeros."""
    text = text or ""
    words, lines = text.split(), text.split("\n")
    n, w = max(len(text), 1), max(len(words), 1)
    byte = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    total = lambda chars: float(sum(byte[ord(c)] for c in chars))
    seen = pd.Series(words, dtype=object).value_counts().to_numpy() if words else np.zeros(1)
    upper, lower = byte[65:91].sum(), byte[97:123].sum() + byte[128:].sum() / 2
    return [
        float(np.log1p(len(text))), (len(text) - len(words)) / w, len(seen) / w, seen[0] / w, upper / n, byte[48:58].sum() / n, total(".,;:?") / w,
        total("#$%&*@~^_=+<>{}[]\\/") / w, total("|") / w, total("!") / w, float(np.log1p(w / len(lines))), len(set(lines)) / len(lines),
        sum(len(x) > 20 for x in words) / w, (upper + lower) / n,
    ]


def tree(grad: np.ndarray, hess: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values by bin of a shallow tree over one feature's bins, from sums of gradients and weights."""
    out = np.zeros(len(grad))

    def grow(lo: int, hi: int, d: int) -> None:
        g, h = grad[lo:hi], hess[lo:hi]
        out[lo:hi] = g.sum() / (h.sum() + 1.0)
        if d and hi - lo > 1:
            gl, hl = g.cumsum()[:-1], h.cumsum()[:-1]
            gr, hr = g.sum() - gl, h.sum() - hl
            gain = np.where((hl * 4 > LEAST_LEAF) & (hr * 4 > LEAST_LEAF), gl**2 / (hl + 1) + gr**2 / (hr + 1), -1.0)
            k = int(gain.argmax())
            if gain[k] > g.sum() ** 2 / (h.sum() + 1) + 1e-9:
                grow(lo, lo + k + 1, d - 1)
                grow(lo + k + 1, hi, d - 1)

    grow(0, len(grad), depth)
    return out


def cross(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of the best tree with one cut on each side of a pair, and its gain."""
    best, value = -1.0, np.zeros_like(grad)
    g2, h2 = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)
    for i in range(grad.shape[0] - 1):
        for j in range(grad.shape[1] - 1):
            parts = []
            for t in (g2, h2):
                a, b, c, d = t[i, j], t[i, -1], t[-1, j], t[-1, -1]
                parts.append(np.array([a, b - a, c - a, d - b - c + a]))
            gain = float((parts[0] ** 2 / (parts[1] + 1)).sum())
            if gain > best:
                leaf = parts[0] / (parts[1] + 1)
                value = np.zeros_like(grad)
                value[: i + 1, : j + 1], value[: i + 1, j + 1 :], value[i + 1 :, : j + 1], value[i + 1 :, j + 1 :] = leaf
                best = gain
    return value, best


@dataclass
class Model:
    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Bin every feature, add the tables' entries, squash."""
        b = self.binned(x)
        total = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            total += t[b[:, j]]
        for i, j, t in self.pairs:
            total += t[b[:, i] * PAIR_BINS // BINS, b[:, j] * PAIR_BINS // BINS]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting: each round gives each feature in turn one shallow tree on what is still unexplained; then the
    pairs with the largest gain take turns. Deterministic. With no rows or one class only, a constant model."""
    n = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(n)]
    rate = (y.sum() + 1) / (len(y) + 2)
    m = Model(edges, float(np.log(rate / (1 - rate))), [np.zeros(BINS) for _ in range(n)], [])
    if len(y) == 0 or y.min() == y.max():
        return m
    b, total = m.binned(x), np.full(len(y), m.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(n):
            g, h = slopes()
            step = RATE * tree(np.bincount(b[:, j], g, BINS), np.bincount(b[:, j], h, BINS))
            m.tables[j] += step
            total += step[b[:, j]]
    c, g, h = b * PAIR_BINS // BINS, *slopes()
    cell = lambda i, j, v: np.bincount(c[:, i] * PAIR_BINS + c[:, j], v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)
    gains = sorted(((cross(cell(i, j, g), cell(i, j, h))[1], i, j) for i in range(n) for j in range(i)), reverse=True)
    m.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in gains[:PAIRS]]
    for _ in range(ROUNDS // 5):
        for i, j, t in m.pairs:
            g, h = slopes()
            step = RATE * cross(cell(i, j, g), cell(i, j, h))[0]
            t += step
            total += step[c[:, i], c[:, j]]
    return m


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits labels.quality on at most sample labelled rows that are not held out, the least by hash of doc_id. Only
    the text is seen; rows with a null label or id don't count. An id counts once: with its larger label, and the text
    that sorts first. Without labelled rows, or with one label only, the model is constant."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # Broadcast: sample rows of two numbers at most.
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            yield pd.DataFrame({"doc_id": t["doc_id"], "y": t["y"], "x": [features(x) for x in t["text"]]})

    got = rows.mapInPandas(run, "doc_id long, y int, x array<double>").toPandas().sort_values("doc_id")  # sample rows at most
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, got["y"].to_numpy(float))


def scored(docs: DataFrame, model: Model, score: str = "quality_score") -> DataFrame:
    """docs with a last column, named score (double, 0 to 1, higher: better), in place of one of that name.

    Every row is scored by itself: null and empty texts, repeated and null ids too; all other columns stay."""
    docs = docs.drop(score)
    names, text_at = docs.columns, docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for b in slices(batches):
            x = np.array([features(t) for t in b.column(text_at).to_pylist()], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(x))], names=[*names, score])

    schema = docs.select("*", F.lit(0.0).alias(score)).schema
    return docs.mapInArrow(run, schema)


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, as scored() has them; held_out is null where doc_id is."""
    out = scored(docs.select("doc_id", "text"), train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier accepts, with docs' columns, whatever their names; rows as in scored()."""
    score = f"score_{uuid.uuid4().hex}"
    return scored(docs, train(docs, labels), score).where(F.col(score) >= THRESHOLD).drop(score)
