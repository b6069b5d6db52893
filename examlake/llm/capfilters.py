"""Embedding near-dedup by spherical-cap filters: structured random product codes, list decoding, verification in blocks."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examlake.llm.common import components, partitions, stored

#: Filters that a linked pair at the threshold is expected to share. Counts vary, as the filters of one code depend on
#: each other: with REPEATS codes about one pair in two thousand at the threshold itself shares none.
SHARED, REPEATS = 16.0, 16
#: Least chance that a filter of one vector of such a pair is one of the other's: caps are never narrower.
OVERLAP = 0.25
#: Directions of a code from which on they are made of two factors; fewer are drawn one by one.
PLAIN = 4096
#: Vectors that are far from each other for each one expected in the same filter.
SPARSE = 8
#: Vectors of a filter that are compared in one block; larger filters are cut into such parts, each pair of which is a block.
PART = 512
#: Vectors of a block up to which its pairs are looked at together with those of other blocks.
SMALL = 16
#: Vectors with links, of several blocks, that are decoded together.
WAITING = 8192


@functools.cache
def _angles(d: int) -> tuple[np.ndarray, np.ndarray]:
    """Angles to a fixed direction in d dimensions, and the share of the sphere within each."""
    a = np.linspace(0, np.pi, 200_001)
    weight = np.sin(a) ** (d - 2) if d > 2 else np.ones_like(a)
    share = np.concatenate([[0.0], np.cumsum((weight[1:] + weight[:-1]) / 2)])
    return a, share / share[-1]


def cap_share(d: int, cosine: float | np.ndarray) -> np.ndarray:
    """The share of the sphere in d dimensions that is at this cosine or more to a direction."""
    if d == 1:
        return np.where(np.asarray(cosine) <= -1, 1.0, np.where(np.asarray(cosine) <= 1, 0.5, 0.0))
    a, share = _angles(d)
    return np.interp(np.arccos(np.clip(cosine, -1, 1)), a, share)


def overlap(d: int, alpha: float, cosine: float) -> float:
    """The chance that a direction within alpha of one vector is so of another at this cosine to it."""
    a, share = _angles(d)
    top = np.searchsorted(a, np.arccos(alpha))
    at = np.unique(np.linspace(1, max(2, top), 400).astype(int))
    mass = np.diff(share[np.concatenate([[0], at])])
    u = np.cos(a[at])
    other = np.sqrt(np.maximum(0.0, (1 - u * u) * (1 - cosine * cosine)))
    need = np.where(other > 0, (alpha - u * cosine) / np.where(other > 0, other, 1.0), np.where(u * cosine >= alpha, -2.0, 2.0))
    shares = np.where(need <= -1, 1.0, np.where(need > 1, 0.0, cap_share(d - 1, np.clip(need, -1, 1))))
    return float((mass * shares).sum() / mass.sum())


@dataclass(frozen=True)
class Code:
    """REPEATS product codes in d dimensions, each of `blocks` factors of `size` codewords; alpha is the least cosine to
    a filter's direction of what it holds."""

    d: int
    blocks: int
    size: int
    alpha: float
    seed: int = 13

    @functools.cached_property
    def parts(self) -> list[list[np.ndarray]]:
        """For each code and factor, d x size: its codewords, turned by a random rotation, at length 1 / sqrt(blocks)."""
        rng, out = np.random.default_rng([self.seed, self.d]), []
        for _ in range(REPEATS):
            turn = np.linalg.qr(rng.normal(size=(self.d, self.d)))[0]
            words = [(own, rng.normal(size=(own.shape[1], self.size))) for own in np.array_split(turn, self.blocks, axis=1)]
            out.append([own @ (w / np.linalg.norm(w, axis=0)) / np.sqrt(self.blocks) for own, w in words])
        return out

    def filters(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List decoding: (row, filter) for every filter whose direction has cosine alpha or more to a row, rows in order."""
        if self.d == 1:
            return np.arange(len(unit)), (unit[:, 0] > 0).astype(np.int64)
        found = [self.decoded(unit, parts) for parts in self.parts]
        who = np.concatenate([w for w, _ in found])
        names = np.concatenate([f + i * self.size**self.blocks for i, (_, f) in enumerate(found)])
        order = np.argsort(who, kind="stable")
        return who[order], names[order]

    def decoded(self, unit: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Of one code: of each factor, only codewords that reach alpha with the best of all others are looked at; what
        the factors so far give goes on where it reaches alpha with the best of all later ones."""
        scores = [unit @ p for p in parts]
        best = np.array([s.max(axis=1) for s in scores])
        who, prefix, total = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
        for b, s in enumerate(scores):
            row, word = np.nonzero(s >= (self.alpha - 1e-12 - (best.sum(axis=0) - best[b]))[:, None])
            first = np.searchsorted(row, np.arange(len(unit) + 1))
            n = first[who + 1] - first[who]
            at = np.repeat(np.arange(len(who)), n)
            word = word[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[who[at]]]
            who, prefix, total = who[at], prefix[at] * self.size + word, total[at]
            total = total + s[who, word]
            reach = total >= self.alpha - best[b + 1 :].sum(axis=0)[who]
            who, prefix, total = who[reach], prefix[reach], total[reach]
        return who, prefix


@functools.cache
def code_for(d: int, n: int, cosine: float, shared: float = SHARED, seed: int = 13) -> Code:
    """The code for n vectors of d dimensions: the more vectors, the narrower and the more caps, so that a filter holds
    few vectors that are far apart, whatever n; but never so narrow that linked pairs would seldom share one."""
    if d == 1:
        return Code(1, 1, 2, 0.5, seed)
    a, share = _angles(d)
    sparse = float(np.cos(np.interp(1.0 / (SPARSE * max(n, 16)), share, a)))
    low, high = 0.0, 0.999
    for _ in range(40):
        mid = (low + high) / 2
        low, high = (mid, high) if overlap(d, mid, cosine) >= OVERLAP else (low, mid)
    alpha = min(sparse, low)
    wanted = shared / overlap(d, alpha, cosine) / float(cap_share(d, alpha)) / REPEATS
    factors = 2 if d >= 16 and wanted > PLAIN else 1
    return Code(d, factors, max(2, int(np.ceil(wanted ** (1 / factors)))), alpha, seed)


def units(vectors: list[np.ndarray] | np.ndarray) -> np.ndarray:
    """Vectors of one dimension at length 1; scaled by a power of two first, so that no square leaves the doubles."""
    v = np.array(vectors, float).reshape(len(vectors), -1)
    v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1))[1][:, None])
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x, h1, h2): rows with an id and a vector that is not zero and has no null or non-finite component; h1 and h2
    are 128 bits of hash that stand for the vector."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double") + F.lit(0.0))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists("x", lambda c: c != 0)
    return rows.where(fine).select("id", "x", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2"))


def memberships(classes: DataFrame, n: int, cosine: float) -> DataFrame:
    """(dim, filter, rep): every filter of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                reps, lists = b.column(0).slice(at, 512).to_numpy(), b.column(1).slice(at, 512)
                dims = np.diff(lists.offsets.to_numpy())
                flat, starts = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(dims) - dims
                for d in np.unique(dims).tolist():
                    own = np.flatnonzero(dims == d)
                    who, found = code_for(d, n, cosine).filters(units([flat[starts[i] : starts[i] + d] for i in own]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(who), d, np.int32)), pa.array(found), pa.array(reps[own][who])], names=["dim", "filter", "rep"])

    return classes.select("rep", "x").mapInArrow(run, "dim int, filter long, rep long")


def first_shared(rows: np.ndarray, columns: np.ndarray, filter_: int, who: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
    """Which pairs (rows, columns) of n vectors have no filter below filter_ in common; (who, found) are their filters."""
    low = found < filter_
    who, found = who[low], found[low]
    _, column, count = np.unique(found, return_inverse=True, return_counts=True)
    several = count[column] > 1
    who, column = who[several], column[several]
    if not len(who):
        return np.ones(len(rows), bool)
    holds = np.zeros((n, column.max() + 1), np.float32)
    holds[who, column] = 1
    holds = holds[:, np.flatnonzero(holds.any(axis=0))]
    return (holds @ holds.T)[rows, columns] == 0


@dataclass
class Linked:
    """The vectors of a block that have links in it, and their linked pairs, as positions among them."""

    filter: int
    reps: np.ndarray
    weights: np.ndarray
    unit: np.ndarray
    a: np.ndarray
    b: np.ndarray


def linked(reps: np.ndarray, weights: np.ndarray, sides: np.ndarray, unit: np.ndarray, filter_: int, cosine: float) -> Linked | None:
    """Pairs of a block at the cosine or more, or None. Where a block holds two parts, only pairs across them are its own
    (sides tell them apart)."""
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    if sides.any() and not sides.all():
        near &= sides[:, None] != sides[None, :]
    own = np.flatnonzero(near.any(axis=1))
    if not len(own):
        return None
    return Linked(filter_, reps[own], weights[own], unit[own], *np.nonzero(np.triu(near[np.ix_(own, own)])))


def counted(blocks_: list[Linked], code: Code) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rep, links, root) of the vectors of each block.

    A pair counts as a link in the least filter that both its vectors are in, and there alone: the filters of all
    vectors that have links are decoded again, once for all blocks. The root is the least vector that a block's links
    reach.
    """
    reps, first = np.unique(np.concatenate([x.reps for x in blocks_]), return_index=True)
    unit = np.concatenate([x.unit for x in blocks_])[first]
    parts = [code.filters(unit[at : at + 512]) for at in range(0, len(unit), 512)]
    found = np.concatenate([f for _, f in parts])
    cuts = np.searchsorted(np.concatenate([w + 512 * i for i, (w, _) in enumerate(parts)]), np.arange(len(reps) + 1))
    for x in blocks_:
        at = np.searchsorted(reps, x.reps)
        n = cuts[at + 1] - cuts[at]
        who = np.repeat(np.arange(len(at)), n)
        own = found[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + cuts[at][who]]
        here = first_shared(x.a, x.b, x.filter, who, own, len(at))
        links = np.zeros(len(at), np.int64)
        np.add.at(links, x.a[here], x.weights[x.b[here]])
        np.add.at(links, x.b[here], x.weights[x.a[here]])
        root = x.reps.copy()
        while True:
            least = root.copy()
            np.minimum.at(least, x.a, root[x.b])
            np.minimum.at(least, x.b, root[x.a])
            if (least == root).all():
                break
            root = least
        yield x.reps, links, root


def promising(unit: np.ndarray, starts: np.ndarray, ends: np.ndarray, cosine: float) -> np.ndarray:
    """Which blocks of consecutive rows may hold a linked pair: all larger ones, and those of up to SMALL rows in which
    some pair is near. Most blocks are small and hold none, so these are looked at together."""
    sizes = ends - starts
    near = sizes > SMALL
    of = np.repeat(np.arange(len(starts)), np.where(near, 0, sizes))
    rows = np.arange(len(of)) - np.repeat(np.cumsum(np.where(near, 0, sizes)) - np.where(near, 0, sizes), np.where(near, 0, sizes)) + starts[of]
    for k in range(1, SMALL):
        at = np.flatnonzero(of[k:] == of[:-k])
        if not len(at):
            break
        for part in np.array_split(at, len(at) // 65_536 + 1):
            hit = np.einsum("ij,ij->i", unit[rows[part]], unit[rows[part + k]]) >= cosine - 1e-9
            near[of[part[hit]]] = True
    return near


def verified(members: DataFrame, n: int, cosine: float) -> DataFrame:
    """(rep, links, root) from members (dim, filter, low, high, side, rep, weight, x): rows of one block follow each
    other in a partition, and a block has at most some two parts' rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # of the open block: (key, sides, reps, weights, unit vectors) of each batch
        waiting: list[Linked] = []  # blocks of one dimension whose links are to be counted

        def block() -> Iterator[pa.RecordBatch]:
            d, f = held[0][0][:2]
            sides, reps, weights, unit = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3, 4))
            got = linked(reps, weights, sides, unit, f, cosine) if len(reps) > 1 else None
            if got:
                if waiting and waiting[0].unit.shape[1] != d:
                    yield from out()
                waiting.append(got)
                if sum(len(x.reps) for x in waiting) >= WAITING:
                    yield from out()

        def out() -> Iterator[pa.RecordBatch]:
            if waiting:
                rows = list(counted(waiting, code_for(waiting[0].unit.shape[1], n, cosine)))
                waiting.clear()
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*rows, strict=True)], names=["rep", "links", "root"])

        for b in batches:
            keys = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(4)], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            sides, reps, weights = (b.column(i).to_numpy() for i in (4, 5, 6))
            lists = b.column(7)
            flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            # Rows come by dimension, so a batch is a few runs of rows of one length.
            turns = [0, *(np.flatnonzero(keys[1:, 0] != keys[:-1, 0]) + 1), len(keys)] if len(keys) else [0]
            starts, ends = np.array([0, *cuts]), np.array([*cuts, len(keys)])
            for lo, hi in zip(turns[:-1], turns[1:], strict=True):
                d = int(keys[lo, 0])
                unit = units(flat[offsets[lo] : offsets[hi]].reshape(hi - lo, d))
                own = np.flatnonzero((starts >= lo) & (ends <= hi))
                near = promising(unit, starts[own] - lo, ends[own] - lo, cosine)
                # The first and the last block of a batch may go on in others.
                near |= (own == 0) | (own == len(starts) - 1)
                for k in own[near].tolist():
                    a, z = starts[k], ends[k]
                    key = tuple(keys[a].tolist())
                    if held and held[0][0] != key:
                        yield from block()
                        held.clear()
                    held.append((key, sides[a:z], reps[a:z], weights[a:z], unit[a - lo : z - lo]))
        if held:
            yield from block()
        yield from out()

    return members.mapInArrow(run, "rep long, links long, root long")


def blocks(held: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of filters that hold two vectors or more, with their vectors, dealt and sorted by block.

    A filter of more than PART vectors is cut by hash; each pair of its parts is a block, so no task holds more than
    two parts, however many vectors share a filter. Filters with one vector, as most are, get no vectors at all.
    """
    sizes = stored(held.groupBy("dim", "filter").agg(F.count("*").alias("n")).where("n > 1"), "cap-sizes")
    cut = held.join(sizes, ["dim", "filter"]).withColumn("cuts", F.ceil(F.col("n") / PART).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("cuts")).cast("int"))
    cut = stored(cut.select("dim", "filter", "rep", "cuts", "own"), "cap-members")
    spread = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = (F.col("own") > F.col("other")).cast("int")
    placed = spread.join(classes.select("rep", "weight", "x"), "rep").select("dim", "filter", low.alias("low"), high.alias("high"), side.alias("side"), "rep", "weight", "x")
    order = ["dim", "filter", "low", "high"]
    return placed.repartition(partitions(held.sparkSession), *order).sortWithinPartitions(*order)


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    n_links counts the other rows at this cosine or more, component_id is the least id reachable by links, and kept
    rows are those that have it. Vectors that are null, zero or hold null or non-finite components link with nothing,
    and so do rows without an id, which have neither a component nor are kept. Rows that repeat an id are each a
    vector, linked with each other if near. Only vectors of one dimension are compared; vectors without components
    link with nothing. Extra columns are ignored, whatever their names; an empty table gives none.

    Equal vectors are one class, counted before any shuffle of pairs. A filter holds what list decoding gives it; links
    are counted in blocks of a filter and never leave it as pairs: a block gives each of its linked vectors one row.
    A linked pair is found unless it shares no filter, which SHARED makes rare; none below the threshold is linked.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, id_col, vector_col), "cap-rows")
    classes = stored(rows.groupBy("h1", "h2").agg(F.min("id").alias("least"), F.count("*").alias("weight"), F.first("x").alias("x")).withColumn("rep", F.monotonically_increasing_id()), "cap-classes")
    n = classes.count()
    held = stored(memberships(classes, n, cosine), "cap-filters")
    found = stored(verified(blocks(held, classes), n, cosine), "cap-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    ends = components(found.where("rep <> root").select(F.col("rep").alias("u"), F.col("root").alias("v")))
    # Classes are numbered as they were written, so the least id of each component follows from its members.
    named = classes.select("rep", "h1", "h2", "least", "weight").join(links, "rep", "left").join(ends, F.col("rep") == F.col("node"), "left")
    named = stored(named.select("h1", "h2", "least", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root")), "cap-named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = stored(named.join(least, "root").select("h1", "h2", "n_links", "component_id"), "cap-classes-named")
    linked = rows.select("id", "h1", "h2").join(known, ["h1", "h2"]).select(F.col("id").alias("vec_id"), "n_links", "component_id")
    fine = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists(x, lambda c: c != 0)
    alone = vectors.where(~F.coalesce(fine & good, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col(id_col).cast("long").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def keep_one(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The rows of vectors without near copies: of each component the row with the least id stays; rows without an id go."""
    ids = near_duplicates(vectors, cosine, id_col, vector_col).where("kept").select(F.col("vec_id").alias(id_col)).distinct()
    return vectors.join(ids, id_col, "left_semi").select(vectors.columns)
