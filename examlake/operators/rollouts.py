"""Scores of repeated answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def full(rollouts: DataFrame, need: int = 5) -> DataFrame:
    """Every answer counts; rollouts: (item, idx, answer, key), an empty answer is invalid."""
    ok, right = F.col("answer") != "", F.col("answer") == F.col("key")
    out = rollouts.groupBy("item").agg(F.count_if(ok & right).alias("correct_count"), F.count_if(ok & ~right).alias("wrong_count"), F.count_if(ok).alias("valid_count"))
    return out.withColumn("decision", F.when(F.col("valid_count") < need, "TECH_FAIL").when(F.col("wrong_count") >= 3, "PASS").otherwise("FAIL"))


def early_stopped(rollouts: DataFrame, n: int = 5, wanted: int = 3) -> DataFrame:
    """Answers count in order until wanted are wrong, or so many are right that this cannot happen any more.

    Calls after the stop are not made. An invalid answer among those made is a technical failure, whatever the counts.
    """
    order = Window.partitionBy("item").orderBy("idx")
    ok, right = F.col("answer") != "", F.col("answer") == F.col("key")
    run = rollouts.withColumns({"_w": F.sum((ok & ~right).cast("int")).over(order), "_c": F.sum((ok & right).cast("int")).over(order)})
    stop = (F.col("_w") >= wanted) | (F.col("_c") > n - wanted)
    before = F.max(stop.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    made = run.withColumn("_stopped", F.coalesce(before, F.lit(0))).where("_stopped = 0")
    out = made.groupBy("item").agg(F.count("*").alias("calls"), F.max("_w").alias("wrong_count"), F.max("_c").alias("correct_count"), F.count_if(ok).alias("valid_count"))
    return out.withColumn("decision", F.when(F.col("valid_count") < F.col("calls"), "TECH_FAIL").when(F.col("wrong_count") >= wanted, "PASS").otherwise("FAIL"))


def majority(rollouts: DataFrame) -> DataFrame:
    """Whether all answers, and most answers, of an item are right."""
    out = rollouts.groupBy("item").agg(F.count("*").alias("n"), F.count_if(F.col("answer") == F.col("key")).alias("c"))
    return out.select("item", "n", "c", (F.col("c") == F.col("n")).alias("all_correct"), (F.col("c") >= F.floor(F.col("n") / 2) + 1).alias("majority"))
