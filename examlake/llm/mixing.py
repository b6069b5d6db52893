"""Mixing sources to target weights: packed blocks, multinomial counts per shard, index permutations."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examlake.llm.common import WORD, partitions, slices, stored, word_count

#: Words in a block, and draws in an output shard.
BLOCK_WORDS, SHARD_SLOTS = 64, 16384
#: Slots of a group of shards; each group is drawn by itself in a task.
GROUP_SLOTS = 1 << 26
#: Weights of the sources in order, repeating; words wanted against words there; most passes over a source.
WEIGHTS, SHARE, PASSES = (5, 2, 1), 1.5, 2
M64 = np.uint64(0xFFFFFFFFFFFFFFFF)


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> list[float]:
    """Words wanted of each source: share of all by weight, none above passes times its size, the excess reshared."""
    w = np.array([weights[i % len(weights)] for i in range(len(sizes))], float)
    cap = passes * np.array(sizes, float)
    out, open_ = np.zeros(len(sizes)), np.ones(len(sizes), bool)
    left = share * float(sum(sizes))
    while open_.any():
        part = np.where(open_, left * w / w[open_].sum(), 0)
        over = open_ & (part > cap)
        if not over.any():
            out[open_] = part[open_]
            break
        out[over] = cap[over]
        left -= cap[over].sum()
        open_ &= ~over
    return out.tolist()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a keyed pseudorandom permutation of 0..n-1 sends each index: four Feistel rounds over the least even
    number of bits that holds n, walked on until the value is below n."""
    bits = np.ceil(np.log2(np.maximum(n, 2).astype(float))).astype(np.uint64)
    bits = np.where(n > (np.uint64(1) << bits), bits + np.uint64(1), bits)
    half = (bits + np.uint64(1)) // np.uint64(2)
    low = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, h, m, k = out[todo], half[todo], low[todo], key[todo]
        a, b = x >> h, x & m
        for r in range(4):
            a, b = b, a ^ (mixed(b ^ mixed(k + np.uint64(r))) & m)
        out[todo] = (a << h) | b
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def draws(slots: list[int], group: int, groups: int, shard_slots: int = SHARD_SLOTS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Counts by shard and source of one group of shards, and each source's first slot in it.

    A group has its part of each source's slots; among its shards they are dealt by multinomial draws, given their sums.
    """
    first = np.array([n * group // groups for n in slots], np.int64)
    left = np.array([n * (group + 1) // groups for n in slots], np.int64) - first
    rng, out = np.random.default_rng([seed, group]), []
    while left.sum():
        got = rng.multivariate_hypergeometric(left, min(shard_slots, int(left.sum())), method="marginals")
        out.append(got)
        left = left - got
    return np.array(out, np.int64).reshape(-1, len(slots)), first


class Plan:
    """Sources, targets and draws for docs; tables of pieces and of chosen blocks.

    Rows that repeat a doc_id within a source are one document: the words of its rows, by hash of the text, one after
    another. Null and blank texts have size 0 and are never taken.
    """

    def __init__(self, docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 7):
        self.spark = spark = docs.sparkSession
        self.block_words = block_words
        sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), row_hash().alias("h"), word_count(F.col("text")).alias("size"))
        one = sizes.groupBy("source", "doc_id", "h").agg(F.sum("size").alias("size"), F.max("size").alias("each"))
        # Frozen with its range partition: the running sums below are per partition, then shifted.
        self.sizes = stored(one.repartitionByRange(partitions(spark), F.col("source").asc_nulls_last(), "doc_id", "h").withColumn("pid", F.spark_partition_id()), "mix-sizes")
        stats = self.sizes.groupBy("source").agg(F.sum("size").alias("n")).collect()  # one row per source
        stats.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        n = [r["n"] for r in stats]
        goal = targets(n)
        blocks = [-(-x // block_words) for x in n]
        slots = [min(PASSES * b, round(t * b / x)) if x else 0 for t, b, x in zip(goal, blocks, n, strict=True)]
        # From Arrow: rows would be made in Python workers of their own, which stay.
        columns = {"source": [r["source"] for r in stats], "sid": range(len(n)), "source_size": n, "target": goal, "blocks": blocks, "slots": slots}
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        self.sources = spark.createDataFrame(pa.table({name: pa.array(x, t) for (name, x), t in zip(columns.items(), kinds, strict=True)}))
        self.slots, self.blocks_, self.seed = slots, blocks, seed
        self.groups = max(1, -(-sum(slots) // GROUP_SLOTS))

    def drawn(self) -> DataFrame:
        """(shard, sid, first, n, blocks): the slots first.. of each source that a shard takes; drawn in tasks."""
        slots, blocks, groups, seed = self.slots, np.array(self.blocks_, np.int64), self.groups, self.seed

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for t in batches:
                for g in t["id"].tolist():
                    by_shard, first = draws(slots, g, groups, seed=seed)
                    at = first + np.cumsum(by_shard, axis=0) - by_shard
                    shard, sid = np.nonzero(by_shard)
                    yield pd.DataFrame({"shard": (g << 20) + shard, "sid": sid, "first": at[shard, sid], "n": by_shard[shard, sid], "blocks": blocks[sid]})

        return self.spark.range(self.groups if slots else 0).repartition(min(self.groups, partitions(self.spark))).mapInPandas(run, "shard long, sid long, first long, n long, blocks long")

    def chosen(self) -> DataFrame:
        """One row per slot: (shard, sid, pass, block)."""
        seed = self.seed

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for t in batches:
                n, go = t["blocks"].to_numpy(), t["slot"].to_numpy() // t["blocks"].to_numpy()
                with np.errstate(over="ignore"):
                    key = mixed((t["sid"].to_numpy().astype(np.uint64) << np.uint64(20)) + go.astype(np.uint64) + np.uint64(seed << 40))
                    block = permuted(t["slot"].to_numpy() % n, n.astype(np.uint64), key)
                yield pd.DataFrame({"shard": t["shard"], "sid": t["sid"], "pass": go, "block": block})

        slot = F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("slot")
        return self.drawn().repartition(partitions(self.spark)).select("shard", "sid", "blocks", slot).mapInPandas(run, "shard long, sid long, pass long, block long")

    def pieces(self) -> DataFrame:
        """(sid, block, doc_id, h, start, words): the words start.. of a row that lie in a block of its source."""
        sums = self.sizes.groupBy("source", "pid").agg(F.sum("size").alias("n"))  # one row per source and range partition
        before = sums.select("source", "pid", (F.sum("n").over(Window.partitionBy("source").orderBy("pid")) - F.col("n")).alias("before"))
        run = F.sum("size").over(Window.partitionBy("source", "pid").orderBy("doc_id", "h")) - F.col("size")
        same = lambda a, b: a.eqNullSafe(b)
        s, b, t = self.sizes.withColumn("run", run).where("size > 0").alias("s"), before.alias("b"), self.sources.alias("t")
        at = s.join(b, same(F.col("s.source"), F.col("b.source")) & (F.col("s.pid") == F.col("b.pid"))).join(t, same(F.col("s.source"), F.col("t.source"))).select("sid", "doc_id", "h", "size", (F.col("before") + F.col("run")).alias("at"))
        w = F.lit(self.block_words)
        block = F.explode(F.sequence(F.floor(F.col("at") / w), F.floor((F.col("at") + F.col("size") - 1) / w))).alias("block")
        cut = at.select("sid", "doc_id", "h", "size", "at", block)
        lo: Column = F.greatest(F.lit(0).cast("long"), F.col("block") * w - F.col("at"))
        hi: Column = F.least(F.col("size"), (F.col("block") + 1) * w - F.col("at"))
        return cut.select(F.col("sid").cast("long").alias("sid"), "block", "doc_id", "h", lo.alias("start"), (hi - lo).alias("words"))

    def taken(self) -> DataFrame:
        """Per document: (doc_id, size, source_size, target, taken)."""
        times = self.chosen().groupBy("sid", "block").agg(F.count("*").alias("times"))
        # Spark takes the exploded slots for few and would broadcast them; both sides grow with the input.
        got = self.pieces().hint("merge").join(times, ["sid", "block"]).groupBy("sid", "doc_id").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        t = self.sources.alias("t")
        whole = self.sizes.alias("s").join(t, F.col("s.source").eqNullSafe(F.col("t.source"))).groupBy(F.col("t.sid").cast("long").alias("sid"), "doc_id", "source_size", "target").agg(F.sum("size").alias("size"))
        g = got.alias("g")
        both = whole.alias("w").join(g, (F.col("w.sid") == F.col("g.sid")) & F.col("w.doc_id").eqNullSafe(F.col("g.doc_id")), "left")
        return both.select("w.doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def blocks(self) -> DataFrame:
        """The mixture: (shard, sid, pass, block, doc_id, h, start, words), the pieces of each drawn block."""
        return self.chosen().join(self.pieces().hint("merge"), ["sid", "block"])


def row_hash() -> Column:
    """Tells rows of one doc_id apart by source and text."""
    return F.xxhash64(F.col("source").cast("string"), F.col("text").cast("string"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 7) -> DataFrame:
    """The mixture as documents with the columns of docs: for each pass in which words of a row are taken, one row with
    these words (ranges side by side stay as written, others are joined by a line end) and n_chars made anew.

    Rows without doc_id, and null and blank texts, are not taken. Rows may repeat a doc_id, or be repeated whole: each
    keeps to its own words. Other columns may have any name; an empty table gives an empty one.
    """
    key, h, copy, ranges = (f"{name}_{uuid.uuid4().hex}" for name in ("id", "h", "copy", "ranges"))
    parts = Plan(docs, block_words, seed).blocks().groupBy(F.col("doc_id").alias(key), F.col("h").alias(h), "pass").agg(F.sort_array(F.collect_list(F.struct("start", "words"))).alias(ranges))  # as many ranges as the document has blocks
    # Rows alike in id, source and text have their words one after another: the copy'th row has the copy'th words.
    order = F.row_number().over(Window.partitionBy(key, h).orderBy(F.lit(0))) - 1
    named = docs.withColumns({key: F.col("doc_id").cast("long"), h: row_hash()}).withColumn(copy, order)
    joined = named.join(parts.drop("pass"), [key, h]).select(*docs.columns, copy, ranges)
    text_at, names = docs.columns.index("text"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(WORD)
        for b in slices(batches):
            out, ok = [], []
            for text, k, found in zip(b.column(text_at).to_pylist(), b.column(len(names)).to_pylist(), b.column(len(names) + 1).to_pylist(), strict=True):
                spans = [m.span() for m in word.finditer(text)]
                runs: list[list[int]] = []
                for r in found:
                    a = max(r["start"] - k * len(spans), 0)
                    z = min(r["start"] + r["words"] - k * len(spans), len(spans))
                    if a < z and runs and runs[-1][1] == a:
                        runs[-1][1] = z
                    elif a < z:
                        runs.append([a, z])
                ok.append(bool(runs))
                out.append("\n".join(text[spans[i][0] : spans[j - 1][1]] for i, j in runs))
            columns = list(b.columns[:-2])
            columns[text_at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(ok, pa.bool_()))

    cut = joined.mapInArrow(run, docs.schema)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else cut
