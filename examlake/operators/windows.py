"""Milestones, chunks, run lengths, hysteresis, stalls and rotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examlake.operators import running


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str = "n") -> DataFrame:
    """A number from 1 on in each group, by order; a group is one task's (running.numbered() has those that are not)."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def complete_chunks(rows: DataFrame, group: list[str], order: list[str], size: int, split: bool = False) -> DataFrame:
    """chunk number by order within a group; only chunks that are full.

    split: for few large groups; each is numbered by several tasks. Else a group is a window's, in one task."""
    if split:
        numbered = running.numbered(rows, group, order, "_n", "_total")
    else:
        own = Window.partitionBy(*group)
        numbered = rows.withColumns({"_n": F.row_number().over(own.orderBy(*order)), "_total": F.count("*").over(own)})
    chunk = F.floor((F.col("_n") - 1) / size).cast("long")
    return numbered.withColumn("chunk", chunk).where((F.col("chunk") + 1) * size <= F.col("_total")).drop("_n", "_total")


def islands(rows: DataFrame, group: list[str], order: list[str], hit: Column) -> DataFrame:
    """Length of the run of hits that ends in each row, 0 where there is none."""
    w = Window.partitionBy(*group).orderBy(*order)
    out = rows.withColumns({"_hit": hit.cast("int"), "_island": F.sum((~hit).cast("int")).over(w)})
    inside = Window.partitionBy(*group, "_island").orderBy(*order)
    return out.withColumn("run_length", F.sum("_hit").over(inside).cast("long")).drop("_hit", "_island")


def settled(rows: DataFrame, group: list[str], order: list[str], zone: str, wait: int = 3) -> DataFrame:
    """acted: whether the zone has been the same for wait rows in a row."""
    w = Window.partitionBy(*group).orderBy(*order)
    changed = F.coalesce((F.col(zone) != F.lag(zone).over(w)).cast("int"), F.lit(1))
    out = rows.withColumn("_run", changed).withColumn("_run", F.sum("_run").over(w))
    place = F.row_number().over(Window.partitionBy(*group, "_run").orderBy(*order))
    return out.withColumn("acted", place >= wait).drop("_run")


def stalled(rows: DataFrame, group: list[str], order: list[str], progress: list[str], busy: Column, checks: int = 5) -> DataFrame:
    """stalled: the last checks rows have one progress vector, and there is work waiting."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(1 - checks, 0)
    same = (F.count("*").over(w) == checks) & (F.size(F.collect_set(F.struct(*progress)).over(w)) == 1)
    return rows.withColumn("stalled", same & busy)


def trailing(rows: DataFrame, group: list[str], order: list[str], value: str, width: int = 50) -> DataFrame:
    """Mean and 95th percentile by index of the last width values; the mean alone below five."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(1 - width, 0)
    out = rows.withColumns({"_v": F.sort_array(F.collect_list(value).over(w)), "mean": F.avg(value).over(w)})
    n = F.size("_v")
    p95 = F.when(n < 5, F.col("mean")).otherwise(F.element_at("_v", F.least(F.floor(n * 0.95).cast("int") + 1, n)))
    return out.withColumn("p95", p95).drop("_v")


def slots(rows: DataFrame, quota: str, cycles: dict[str, list[str]]) -> DataFrame:
    """One row per slot 1..quota with values taken in turn from each cycle."""
    out = rows.where(F.col(quota) > 0).withColumn("slot", F.explode(F.sequence(F.lit(1), F.col(quota))))
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.pmod(F.col("slot") - 1, F.lit(len(values))) + 1)
    return out.withColumns({name: pick(values) for name, values in cycles.items()})


def blueprint(rows: DataFrame, quota: str, pattern: Column, archetypes: list[str], images: list[str], skills: list[str], english: int = 6) -> DataFrame:
    """One row per slot with all that a question is planned by (W4): difficulty by pattern, archetype, image type and
    skill in turn, image types moved on by one with each round of archetypes, and every english-th slot in English."""
    out = rows.withColumn("_pattern", pattern).withColumn("slot", F.explode(F.sequence(F.lit(1), F.greatest(F.col(quota), F.lit(1)))))
    i = F.col("slot") - 1
    turn = lambda values, at: F.element_at(F.array(*map(F.lit, values)), (F.pmod(at, F.lit(len(values))) + 1).cast("int"))
    level = F.element_at("_pattern", (F.pmod(i, F.size("_pattern")) + 1).cast("int"))
    return out.withColumns({"language": F.when(F.col("slot") % english == 0, "en").otherwise("zh"), "difficulty": level, "archetype": turn(archetypes, i), "image_type": turn(images, i + F.floor(i / len(archetypes))), "competency": turn(skills, i)}).drop("_pattern")


def escalated(incidents: DataFrame, group: list[str], order: list[str], level: str, most: int = 5) -> DataFrame:
    """paused: a critical incident, or an error that is at least the most-th of those noted; warnings count."""
    w = Window.partitionBy(*group).orderBy(*order)
    noted = F.sum((F.col(level) != "CRITICAL").cast("int")).over(w)
    return incidents.withColumn("paused", (F.col(level) == "CRITICAL") | ((F.col(level) == "ERROR") & (noted >= most)))
