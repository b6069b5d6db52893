"""Current state over append-only events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(events: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """The values of the last event of each key: one aggregate, no self-join."""
    last = F.max_by(F.struct(*columns), F.col(order)).alias("s")
    return events.groupBy(key).agg(F.max(order).alias(order), last).select(key, order, *[F.col(f"s.{c}").alias(c) for c in columns])


def upsert_fold(writes: DataFrame, key: str, order: str, keep: list[str], replace: list[str]) -> DataFrame:
    """Writes folded per key: keep columns from the first write, replace columns from the last (K5)."""
    return writes.groupBy(key).agg(*[F.min_by(c, order).alias(c) for c in keep], *[F.max_by(c, order).alias(c) for c in replace], F.count("*").alias("writes"))


def partial_updates(updates: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Last non-null value of each column (K6)."""
    return updates.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])


def insert_ignore(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of new whose key is not there yet, one per key: the one that sorts first by its other columns (K2). Reduced
    within tasks before the shuffle."""
    rest = [c for c in new.columns if c != key]
    missing = new.join(existing.select(key), key, "left_anti")
    if not rest:
        return missing.distinct()
    return missing.groupBy(key).agg(F.min(F.struct(*rest)).alias("_first")).select(*[F.col(c) if c == key else F.col(f"_first.{c}").alias(c) for c in new.columns])


def illegal_transitions(log: DataFrame, allowed: DataFrame) -> DataFrame:
    """Audit rows (old_status, new_status) that the table of transitions does not have."""
    same = log["old_status"].eqNullSafe(allowed["old_status"]) & (log["new_status"] == allowed["new_status"])
    return log.join(allowed, same, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent, F.col(child_key) == F.col(parent_key), "left_anti")


def outside(column: Column, allowed: list) -> Column:
    return ~column.isin(allowed)
