"""Semi, anti and full-outer reconciliation, lookups, overlays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def verified(rows: DataFrame, passed: DataFrame, key: str) -> DataFrame:
    return rows.join(passed, key, "left_semi")


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done, key, "left_anti")


def references(referenced: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Each key with state matched, missing (referenced only) or extra (existing only)."""
    a, b = referenced.select(*keys).distinct().withColumn("_r", F.lit(1)), existing.select(*keys).distinct().withColumn("_e", F.lit(1))
    state = F.when(F.col("_e").isNull(), "missing").when(F.col("_r").isNull(), "extra").otherwise("matched")
    return a.join(b, keys, "full_outer").select(*keys, state.alias("state"))


def looked_up(rows: DataFrame, names: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """rows with value from names, or default; small tables are broadcast by Spark's own size check."""
    return rows.join(names, key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def overlaid(sources: DataFrame, key: str, priority: str, columns: list[str]) -> DataFrame:
    """Per key and column the last non-null value by priority."""
    return sources.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(priority))).alias(c) for c in columns])


def first_of(sources: DataFrame, key: str, priority: str) -> DataFrame:
    """One row per key, of the smallest priority, ties to the row that sorts first."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(priority, *[c for c in sources.columns if c not in (key, priority)]))
    return sources.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def in_both(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that both have, once each."""
    return a.select(key).intersect(b.select(key))
