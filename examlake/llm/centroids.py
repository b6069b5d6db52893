"""Dual-tree Lloyd clustering: cover trees over blocks of vectors, a tree over the centroids of each round."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examlake.llm.common import stored

#: Vectors of a block (one cover tree), of a leaf of it, and centroids of a leaf of theirs.
BLOCK, LEAF, CENTROID_LEAF = 4096, 24, 1
#: Sums are carried in digits of this many bits, so that they are exact for any finite components.
DIGIT = 40
#: Relative room for rounding in bounds; what is closer is compared exactly.
ROOM = 1e-9

Tree = dict[str, np.ndarray]


def integers(x: np.ndarray, scale: float = 1024.0) -> np.ndarray:
    """floor(scale * x) as longs, or as Python integers where one is beyond 2^53."""
    with np.errstate(over="ignore"):
        v = np.floor(x * scale)
    if not v.size or np.abs(v).max() < 2.0**53:
        return v.astype(np.int64)
    # Powers of two scale exactly, so the product can be taken after the floats became integers.
    return np.array([[int(c) if np.isfinite(c) else int(a) * int(scale) for c, a in zip(r, s, strict=True)] for r, s in zip(v, x, strict=True)], object).reshape(v.shape)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of v to all rows of c: in doubles while they hold them, else in integers."""
    d = v.shape[1]
    if v.dtype != object and c.dtype != object:
        most = float(np.abs(v).max(initial=0)) + float(np.abs(c).max(initial=0))
        if d * most * most < 2.0**53:
            a, b = v.astype(float), c.astype(float)
            return np.rint((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    a, b = v.astype(object), c.astype(object)
    return np.array([[sum((x - y) ** 2 for x, y in zip(p, q, strict=True)) for q in b] for p in a], object).reshape(len(a), len(b))


def as_floats(v: np.ndarray) -> np.ndarray:
    """v in doubles; what is beyond them is infinite, so that no bound is drawn from it."""
    if v.dtype != object:
        return v.astype(float)
    most = int(np.finfo(float).max)
    return np.array([[float(c) if abs(c) <= most else np.copysign(np.inf, c > 0 or -1) for c in r] for r in v], float).reshape(v.shape)


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """A cover tree in arrays: node i holds the points order[start[i]:end[i]], has a point as centre, the radius of its
    points around it, and the children child[i]:last[i] (none for a leaf). Node 0 is the root.

    The children of a node of radius r are centred on points more than r/2 apart, its own centre first, and cover its
    points within r/2 each. A node that holds one place, or few points, is a leaf. Where more than a quarter of the
    points would be centres, as in noise of many dimensions, balls bring nothing: those that hold several points are
    kept, and what else is left is one leaf.
    """
    p = as_floats(points)
    order = np.arange(len(p))
    start, end, centre, radius, child, last = [0], [len(p)], [0], [0.0], [0], [0]
    with np.errstate(over="ignore", invalid="ignore"):
        radius[0] = float(np.sqrt(((p - p[:1]) ** 2).sum(axis=1)).max(initial=0.0))
    work = [0]
    while work:
        node = work.pop()
        at = order[start[node] : end[node]]
        if len(at) <= leaf or not radius[node] > 0 or not np.isfinite(radius[node]):
            continue
        half, left, groups, c = radius[node] / 2, at, [], centre[node]
        while len(left) and len(groups) <= max(2, len(at) // 4):
            d = np.sqrt(((p[left] - p[c]) ** 2).sum(axis=1))
            near = d <= half
            near |= left == c
            groups.append((c, left[near], float(d[near].max(initial=0.0))))
            left, d = left[~near], d[~near]
            if len(left):
                c = int(left[d.argmax()])
        if len(left):
            loose = np.concatenate([left, *(held for _, held, _ in groups if len(held) == 1)])
            groups = [g for g in groups if len(g[1]) > 1]
            if not groups:
                continue
            c = int(loose[0])
            groups.append((c, loose, float(np.sqrt(((p[loose] - p[c]) ** 2).sum(axis=1)).max())))
        child[node], last[node] = len(start), len(start) + len(groups)
        pos = start[node]
        for i, (c, held, r) in enumerate(groups):
            order[pos : pos + len(held)] = held
            if not len(left) or i < len(groups) - 1:
                work.append(len(start))
            start.append(pos)
            end.append(pos + len(held))
            centre.append(c)
            radius.append(r)
            child.append(0)
            last.append(0)
            pos += len(held)
    return {"order": order, "start": np.array(start), "end": np.array(end), "centre": np.array(centre), "radius": np.array(radius), "child": np.array(child), "last": np.array(last)}


def expanded(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the numbers first[i]..last[i]-1: (i repeated, numbers)."""
    n = last - first
    who = np.repeat(np.arange(len(n)), n)
    return who, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[who]


def nearest(tree: Tree, points: np.ndarray, floats: np.ndarray, centroids: np.ndarray, over: Tree) -> Iterator[tuple[np.ndarray, int]]:
    """(positions of points, their centroid): every point once, by exact distance, ties to the smaller number.

    Pairs of a ball of points and a ball of centroids go down both trees level by level. A pair goes when its least
    possible distance is over another pair's greatest for the same points; points left with one centroid take it whole.
    Leaves that are left with several are compared exactly.
    """
    q = as_floats(centroids)
    x, c = np.array([0]), np.array([0])
    if not len(points):
        return
    with np.errstate(over="ignore", invalid="ignore"):
        while len(x):
            away = np.sqrt(((floats[tree["centre"][x]] - q[over["centre"][c]]) ** 2).sum(axis=1))
            around = tree["radius"][x] + over["radius"][c]
            nodes, row = np.unique(x, return_inverse=True)
            top = np.full(len(nodes), np.inf)
            np.minimum.at(top, row, away + around)
            keep = ~(away - around > top[row] * (1 + ROOM) + ROOM)
            x, c, row = x[keep], c[keep], row[keep]
            lone = over["end"][c] - over["start"][c] == 1
            # A node with one centroid left is done.
            count = np.bincount(row, minlength=len(nodes))
            done = (count[row] == 1) & lone
            for node, k in zip(x[done], c[done], strict=True):
                yield tree["order"][tree["start"][node] : tree["end"][node]], int(over["order"][over["start"][k]])
            x, c, row, lone = x[~done], c[~done], row[~done], lone[~done]
            # The points are split where their ball is the larger one, else the centroids.
            wide = np.zeros(len(nodes))
            np.maximum.at(wide, row, over["radius"][c])
            whole = np.ones(len(nodes), bool)
            np.logical_and.at(whole, row, over["last"][c] == over["child"][c])
            splits = tree["last"][x] > tree["child"][x]
            down = splits & (whole[row] | (tree["radius"][x] >= wide[row]))
            compare = ~splits & whole[row]
            for node in np.unique(x[compare]):
                own = c[compare & (x == node)]
                ids = np.sort(np.concatenate([over["order"][over["start"][k] : over["end"][k]] for k in own]))
                at = tree["order"][tree["start"][node] : tree["end"][node]]
                best = ids[squared(points[at], centroids[ids]).argmin(axis=1)]
                for k in np.unique(best):
                    yield at[best == k], int(k)
            who, kids = expanded(tree["child"][x[down]], tree["last"][x[down]])
            rest = ~down & ~compare
            cx, cc = x[rest], c[rest]
            leaf = over["last"][cc] == over["child"][cc]
            more, below = expanded(over["child"][cc[~leaf]], over["last"][cc[~leaf]])
            x, c = np.concatenate([kids, cx[leaf], cx[~leaf][more]]), np.concatenate([c[down][who], cc[leaf], below])


BLOCKS = "n int, dim int, kind string, ids binary, vectors binary, " + ", ".join(f"`{k}` binary" for k in ("order", "start", "end", "centre", "radius", "child", "last"))


def _frozen(v: np.ndarray) -> tuple[str, bytes]:
    """Kind and bytes: the shortest whole numbers that hold v, or text for those beyond a long."""
    if v.dtype == object:
        return "text", ",".join(map(str, v.ravel())).encode()
    kind = next(k for k in ("<i2", "<i4", "<i8") if np.abs(v).max(initial=0) <= np.iinfo(k).max)
    return kind, v.astype(kind).tobytes()


def _thawed(kind: str, data: bytes, n: int, dim: int) -> np.ndarray:
    if kind == "text":
        return np.array([int(t) for t in data.decode().split(",")], object).reshape(n, dim)
    return np.frombuffer(data, kind).astype(np.int64).reshape(n, dim)


def blocks(vectors: DataFrame, dim: int, scale: float = 1024.0, size: int = BLOCK) -> DataFrame:
    """Kept vectors in blocks of `size`, each with its cover tree; made where the vectors are read, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        held: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            v = integers(np.concatenate(held), scale)
            kind, data = _frozen(v)
            row = {"n": len(v), "dim": dim, "kind": kind, "ids": np.concatenate(ids).astype("<i8").tobytes(), "vectors": data}
            row |= {k: t.astype("<f8" if k == "radius" else "<i4").tobytes() for k, t in cover_tree(v).items()}
            ids.clear()
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("n", pa.int32()), ("dim", pa.int32()), ("kind", pa.string()), *((f, pa.binary()) for f in list(row)[3:])]))

        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim)
            at = 0
            while at < len(x):
                take = min(len(x) - at, size - sum(map(len, held)))
                ids.append(b.column(0).to_numpy()[at : at + take])
                held.append(x[at : at + take])
                at += take
                if sum(map(len, held)) == size:
                    yield block()
        if held:
            yield block()

    return vectors.select("id", "x").mapInArrow(run, BLOCKS)


def _read(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, Tree]:
    v = _thawed(r["kind"], r["vectors"], r["n"], r["dim"])
    return np.frombuffer(r["ids"], "<i8"), v, as_floats(v), {k: np.frombuffer(r[k], "<f8" if k == "radius" else "<i4") for k in ("order", "start", "end", "centre", "radius", "child", "last")}


def digits(value: int) -> list[int]:
    """value in digits of DIGIT bits from the lowest on, the last one signed; their sums give the sum of values."""
    out = []
    while not -(1 << DIGIT) <= value < 1 << DIGIT:
        out.append(value & ((1 << DIGIT) - 1))
        value >>= DIGIT
    return [*out, value]


def sums(trees: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Of each centroid that is nearest to some vector: how many, and the exact sum of each component.

    Every task adds up its blocks; what comes back to the driver has a row for each centroid, component and digit.
    """
    over, dim = cover_tree(centroids, CENTROID_LEAF), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros(centroids.shape, object)
        for b in batches:
            for r in b.to_pylist():
                _, v, floats, tree = _read(r)
                part = np.zeros(centroids.shape, np.int64)
                small = v.dtype != object and np.abs(v).max(initial=0) < 2**48
                for at, k in nearest(tree, v, floats, centroids, over):
                    count[k] += len(at)
                    if small:
                        part[k] += v[at].sum(axis=0)
                    else:
                        total[k] += v[at].astype(object).sum(axis=0)
                if small:
                    total += part.astype(object)
        out = [(k, -1, 0, int(count[k])) for k in np.flatnonzero(count)]
        out += [(int(k), i, j, d) for k in np.flatnonzero(count) for i in range(dim) for j, d in enumerate(digits(int(total[k, i])))]
        columns = zip(*out, strict=True) if out else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["cluster", "component", "digit", "value"])

    parts = trees.mapInArrow(run, "cluster int, component int, digit int, value long")
    rows = parts.groupBy("cluster", "component", "digit").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    found: dict[int, tuple[int, list[int]]] = {r["cluster"]: (int(r["value"]), [0] * dim) for r in rows if r["component"] < 0}
    for r in rows:
        if r["component"] >= 0:
            found[r["cluster"]][1][r["component"]] += int(r["value"]) << (DIGIT * r["digit"])
    return found


def array_of(rows: list[list[int]], dim: int) -> np.ndarray:
    wide = any(abs(c) >= 2**53 for r in rows for c in r)
    return np.array(rows, object if wide else np.int64).reshape(len(rows), dim)


def lloyd(trees: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """Centroids after so many rounds; a round that changes nothing is the last, as all after it would be the same."""
    for _ in range(rounds):
        found = sums(trees, centroids)
        rows = [[s // found[k][0] for s in found[k][1]] if k in found else [int(c) for c in centroids[k]] for k in range(len(centroids))]
        moved = array_of(rows, centroids.shape[1])
        if (moved == centroids).all():
            break
        centroids = moved
    return centroids


def assigned(trees: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector, distances beyond a long held to its range."""
    over = cover_tree(centroids, CENTROID_LEAF)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, v, floats, tree = _read(r)
                cluster, distance = np.zeros(len(v), np.int32), np.zeros(len(v), np.int64)
                for at, k in nearest(tree, v, floats, centroids, over):
                    cluster[at] = k
                    d = squared(v[at], centroids[k : k + 1])[:, 0]
                    distance[at] = np.minimum(d, 2**63 - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(cluster), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return trees.mapInArrow(run, "vec_id long, cluster int, distance long")


def kept(vectors: DataFrame, dim: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x): vectors of exactly dim finite components with an id, as doubles."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = vectors.where(F.col(id_col).isNotNull() & (F.size(vector_col) == dim)).select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
    return rows.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))


def first_centroids(rows: DataFrame, k: int, seed: int, scale: float = 1024.0) -> np.ndarray:
    """The k vectors with the least sha256 of seed and id, in that order; rows that repeat an id follow in the order of
    their components."""
    least = rows.select("x", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("h")).orderBy("h", "x").limit(k).collect()
    return array_of([[int(c) for c in integers(np.array([r["x"]]), scale)[0]] for r in least], len(least[0]["x"]) if least else 0)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, seed: int = 3, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Vectors are kept if they have dim components, none null or non-finite, and an id; rows that repeat an id are each a
    vector. Fewer than k give as many centroids as there are, an empty table gives none; equal centroids leave the one
    with the greater number empty. Distances and their sums beyond a long are held to its range. Extra columns are
    ignored, whatever their names.

    Vectors are read once and written as blocks with their trees; a round reads the blocks, and only sums leave it.
    """
    spark = vectors.sparkSession
    rows = kept(vectors, dim, id_col, vector_col)
    start = first_centroids(rows, k, seed, scale)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(start):
        return spark.createDataFrame([], schema)
    trees = stored(blocks(rows, dim, scale), "cover-trees")
    centroids = lloyd(trees, start, rounds)
    found = stored(assigned(trees, centroids), "clusters")
    total = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row a centroid
    inertia, most = {r["cluster"]: int(r["s"]) for r in total}, 2**63 - 1
    names = [(c, min(s, most), min(sum(inertia.values()), most), hashlib.sha256(",".join(str(x) for x in centroids[c]).encode()).hexdigest()) for c, s in inertia.items()]
    described = spark.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(described), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
