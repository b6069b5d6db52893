"""Counts, deficits and quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def progress_matrix(records: DataFrame, subject: str, status: str, statuses: list[str]) -> DataFrame:
    """One row per subject with a zero-filled count of every status and their total (A1, A2)."""
    out = records.groupBy(subject).pivot(status, statuses).count().na.fill(0)
    return out.withColumn("total", sum((F.col(s) for s in statuses), F.lit(0)))


def status_rollup(records: DataFrame, subject: str, status: str, buckets: dict[str, list[str]]) -> DataFrame:
    """Counts of named buckets of statuses in one pass (A5)."""
    counts = [F.count_if(F.col(status).isin(v)).alias(k) for k, v in buckets.items()]
    return records.groupBy(subject).agg(F.count("*").alias("generated"), *counts)


def deficits(have: DataFrame, quotas: DataFrame, keys: list[str]) -> DataFrame:
    """quota, done and max(0, quota - done) per key; keys without records have done 0."""
    done = F.coalesce("done", F.lit(0))
    return quotas.join(have, keys, "left").withColumns({"done": done, "need": F.greatest(F.lit(0), F.col("quota") - done)})


def histogram(values: DataFrame, column: str, bins: DataFrame) -> DataFrame:
    """Counts over all bins, absent ones as 0 (A9); bins: one column named like column."""
    counts = values.groupBy(column).agg(F.count("*").alias("n"))
    return bins.join(counts, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def apportioned(rows: DataFrame, group: list[str], total: Column, weight: str, index: str) -> DataFrame:
    """Largest-remainder shares of total within a group, as column share.

    Each row gets 1 first if there is enough for all; the rest is split by weight, what is left goes one by one to the
    largest fractions, then weights, then smaller indexes. Weights that sum to 0 count as equal.
    """
    g = Window.partitionBy(*group)
    n, weights = F.count("*").over(g), F.sum(weight).over(g)
    base = F.when(total >= n, 1).otherwise(0)
    spread = F.when(weights > 0, F.col(weight) / weights).otherwise(1 / n)
    raw = (total - base * n) * spread
    cut = rows.withColumns({"_base": base, "_raw": raw}).withColumns({"_floor": F.floor("_raw"), "_fraction": F.col("_raw") - F.floor("_raw")})
    left = total - F.sum(F.col("_base") + F.col("_floor")).over(g)
    rank = F.row_number().over(g.orderBy(F.desc("_fraction"), F.desc(weight), F.asc(index)))
    return cut.withColumn("share", (F.col("_base") + F.col("_floor") + F.when(rank <= left, 1).otherwise(0)).cast("long")).drop("_base", "_raw", "_floor", "_fraction")


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= n)


def over_provisioned(need: Column) -> Column:
    """Extra items against losses: three more for small needs, then half, then 30 per cent more."""
    return F.when(need <= 0, 0).when(need <= 5, need + 3).when(need <= 20, (need * 1.5 + 0.999).cast("int")).otherwise((need * 1.3 + 0.999).cast("int"))


def custom_deficits(rows: DataFrame, subject: str, key: str, have: str, target: int, first: int) -> DataFrame:
    """Quotas of a run for a target per subject (A32, A17): subjects that have it are left out; of the others the first
    keys get what they have and a share of the gap (W11); need is that share."""
    done = F.sum(have).over(Window.partitionBy(subject))
    short = rows.withColumn("_gap", F.greatest(F.lit(0), target - done)).where("_gap > 0")
    top = top_per_group(short, [subject], [F.asc(key)], first).drop("rank")
    shared = apportioned(top.withColumn("_w", F.lit(1)), [subject], F.col("_gap"), "_w", key)
    return shared.withColumns({"quota": F.col(have) + F.col("share"), "need": F.col("share")}).drop("_gap", "_w", "share")
