"""Exact top-k inner products by norm-bucketed retrieval."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from examlake.llm.common import partitions, stored

#: Vectors of a bucket, and queries of a block.
BUCKET, QUERIES = 4096, 512
#: From this cosine on, a bucket is pruned by coordinates; below it by length alone.
STEEP, FOCUS = 0.6, 2

PACKED = "dim int, block long, n int, longest double, ids binary, vectors binary"


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(id, v, dim, norm) with v = floor(scale * x) in exact doubles; vectors that are null or hold null or non-finite
    components are left out, and so are rows without an id."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    x = F.transform(vector_col, lambda v: v.cast("double"))
    # Long vectors of huge values may exceed a double's range: such a norm is infinite, and is never pruned.
    v = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(F.forall("x", fine))
    v = v.select("id", F.transform("x", lambda c: F.rint(c * scale) - F.when(F.rint(c * scale) > c * scale, 1.0).otherwise(0.0)).alias("v"))
    return v.select("id", "v", F.size("v").alias("dim"), F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)).alias("norm"))


def packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Blocks of size vectors of one dimension and like length, longest first; written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, k = [], TaskContext.get().partitionId() << 32

        def block() -> pa.RecordBatch:
            nonlocal k
            k += 1
            row = {"dim": len(held[0][1]), "block": k, "n": len(held), "longest": max(h[2] for h in held), "ids": np.array([h[0] for h in held], "<i8").tobytes(), "vectors": np.array([h[1] for h in held], "<f8").tobytes()}
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("longest", pa.float64()), ("ids", pa.binary()), ("vectors", pa.binary())]))

        for b in batches:
            values = b.column(1)
            flat, cuts = values.flatten().to_numpy(zero_copy_only=False), values.offsets.to_numpy() - values.offsets[0].as_py()
            for i, (id_, norm) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)):
                v = flat[cuts[i] : cuts[i + 1]]
                if held and (len(held) == size or len(held[0][1]) != len(v)):
                    yield block()
                held.append((id_, v, norm))
        if held:
            yield block()

    spark = rows.sparkSession
    ordered = rows.repartitionByRange(partitions(spark), "dim", F.desc("norm"), "id").sortWithinPartitions("dim", F.desc("norm"), "id")
    return stored(ordered.select("id", "v", "norm").mapInArrow(run, PACKED), name)


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products: doubles while all partial sums are below 2^53, else Python integers (held to
    the range of a long)."""
    if q.size and v.size and np.abs(q).max() * np.abs(v).max() * q.shape[1] < 2.0**53:
        return np.rint(q @ v.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
    if not q.shape[1]:
        return np.zeros((len(q), len(v)), np.int64)
    return np.clip(whole(q) @ whole(v).T, -(2**63), 2**63 - 1).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def search(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, v: np.ndarray, v_ids: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(query, vector, score) of each query's k best in one bucket, of those at or above its floor.

    floor / (|q| * longest) is the least cosine that a vector of the bucket needs. If it is steep, only vectors are
    verified whose largest query coordinates lie where that cosine allows; else those long enough for the floor.
    """
    q_len, v_len = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(floor > 0, floor / q_len, 0.0) * (1 - 1e-9)  # least length
        cosine = np.where(v_len.max() > 0, need / v_len.max(), 0.0)
        unit = np.where(v_len[:, None] > 0, v / v_len[:, None], 0.0)
    for i in np.flatnonzero(~(need > v_len.max())):
        ok = ~(v_len < need[i])
        if cosine[i] >= STEEP and np.isfinite(q_len[i] * v_len.max()):
            c, direction = min(cosine[i], 1.0), q[i] / q_len[i]
            for f in np.argsort(-np.abs(direction))[:FOCUS]:
                # Angles add: a vector within arccos(c) of the query has its coordinate between these cosines.
                room = np.sqrt(max(0.0, (1 - c * c) * (1 - direction[f] ** 2)))
                low = -1.0 if direction[f] <= -c else direction[f] * c - room
                high = 1.0 if direction[f] >= c else direction[f] * c + room
                ok &= (unit[:, f] >= low - 1e-9) & (unit[:, f] <= high + 1e-9)
        at = np.flatnonzero(ok & (v_ids != q_ids[i]))
        if len(at):
            scores = products(q[i : i + 1], v[at])[0]
            for j in best(scores, v_ids[at], k):
                if scores[j] >= floor[i]:
                    yield int(q_ids[i]), int(v_ids[at[j]]), int(scores[j])


def admitted(buckets: DataFrame, ready: DataFrame, parts: int) -> DataFrame:
    """(block, q_block) of one dimension whose products may reach the floor; salted by q_block, as dim may be one value."""
    asked = ready.select("dim", "q_block", "need", F.pmod("q_block", F.lit(parts)).cast("int").alias("salt"))
    salted = buckets.select("dim", "block", "longest", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("salt"))
    return salted.join(asked, ["dim", "salt"]).where(~(F.col("longest") < F.col("need") * (1 - 1e-9))).select("block", "q_block")


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k best of all other vectors for each vector whose id is divisible by every: (query_id, rank, vec_id, score).

    Vectors that are null or hold null or non-finite components, and rows without an id, take no part; rows that repeat
    an id are each a vector, and none of them is compared with its own id; scores beyond a long are held to its range,
    and tie there. Extra columns are ignored, whatever their names; fewer than k others give all of them, an empty
    table gives none.

    Only vectors of the query's dimension are compared. Each query's floor is its k-th score within the bucket of
    longest vectors; pairs of query block and bucket that no product can lift to the floor are never joined.
    """
    spark = vectors.sparkSession
    rows = stored(whole_vectors(vectors, id_col, vector_col), "vectors")
    buckets = packed(rows, BUCKET, "buckets")
    asked = packed(rows.where(F.col("id") % every == 0), QUERIES, "queries")
    first = buckets.groupBy("dim").agg(F.max_by("block", "longest").alias("block"))
    q = lambda s, t: (np.frombuffer(s, "<i8"), np.frombuffer(t, "<f8"))

    def floors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            for r in t.itertuples():
                q_ids, qs = q(r.q_ids, r.q_vectors)
                ids, vs = q(r.ids, r.vectors)
                qs, vs = qs.reshape(len(q_ids), -1), vs.reshape(len(ids), -1)
                scores = products(qs, vs)
                out = np.full(len(q_ids), -(2.0**63))
                for i in range(len(q_ids)):
                    other = scores[i][ids != q_ids[i]]
                    if len(other) >= k:
                        out[i] = float(np.partition(other, -k)[-k])
                out = np.where(np.abs(out) >= 2.0**53, np.nextafter(out, -np.inf), out)  # a long rounds as a double
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(out > 0, out / np.sqrt((qs * qs).sum(axis=1)), 0.0)
                yield pd.DataFrame({"dim": [r.dim], "q_block": [r.q_block], "need": [float(np.nan_to_num(need).min())], "q_ids": [r.q_ids], "q_vectors": [r.q_vectors], "floors": [out.tobytes()]})

    named = asked.select("dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    seeds = buckets.join(first, ["dim", "block"]).select("dim", "ids", "vectors")
    # Broadcast, as dim may be one value: one bucket of BUCKET vectors for each dimension is all there is.
    ready = stored(named.join(F.broadcast(seeds), "dim").mapInPandas(floors, "dim int, q_block long, need double, q_ids binary, q_vectors binary, floors binary"), "floors")
    pairs = admitted(buckets, ready, partitions(spark))
    work = pairs.repartition(partitions(spark), "block", "q_block").join(buckets.select("block", "ids", "vectors"), "block").join(ready.select("q_block", "q_ids", "q_vectors", "floors"), "q_block")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            for r in t.itertuples():
                q_ids, qs = q(r.q_ids, r.q_vectors)
                ids, vs = q(r.ids, r.vectors)
                found = search(qs.reshape(len(q_ids), -1), q_ids, np.frombuffer(r.floors), vs.reshape(len(ids), -1), ids, k)
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = work.select("q_ids", "q_vectors", "floors", "ids", "vectors").mapInPandas(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
