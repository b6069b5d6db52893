"""Helpers shared by the training-data operators: table access, scratch tables, union of links."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One or more of the ASCII blanks; words are the runs between them.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Only a local session without that setting (a test) gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of record batches, so that what a task holds as Python objects stays small; what Arrow has kept from a
    batch goes back to the system with it."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
        del b
        pa.default_memory_pool().release_unused()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once a row, also where body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_count(text: Column) -> Column:
    """Words of a text, null counting as empty; one pass over the text, no array of words.

    The runs of word characters shrink to one letter, the blanks go, and the rest is counted.
    """
    kept = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x")
    return F.length(F.regexp_replace(kept, BLANKS, "")).cast("long")


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of links (u, v): one row (node, root) per node, root the least node reached.

    Alternates large-star and small-star steps, so that chains of any length take a logarithmic number of rounds.
    A star is an aggregate and a join, never a collected list of neighbours; each round is written to the shared
    folder. Self-links are ignored; no links give no rows.
    """
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lower.select("u", "m")).distinct()
        now = stored(small, "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    roots = now.select(F.col("v").alias("u"), "v").union(now)
    return roots.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
