"""Deterministic samples by hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Multiplier and modulus of the arithmetic hash.
MULTIPLIER, MODULUS = 2654435761, 4294967296


def hashed(key: Column, seed: int = 0) -> Column:
    """An arithmetic hash that any SQL engine computes alike."""
    return F.pmod((key + seed) * MULTIPLIER, F.lit(MODULUS))


def stratified(rows: DataFrame, group: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly n rows of each group (all, if fewer), the first by hash order."""
    order = Window.partitionBy(group).orderBy(hashed(F.col(key), seed), key)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
