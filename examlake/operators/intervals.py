"""Leases as intervals: what falls within them, overlaps and gaps (ST11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number(at: Column) -> Column:
    """Dates as days, all else as it counts: what bins are cut from."""
    return F.datediff(at, F.lit("1970-01-01").cast("date")).cast("long")


def points_within(intervals: DataFrame, points: DataFrame, start: str, end: str, at: str, width: int, on: list[str]) -> DataFrame:
    """Each interval with each point at or after its start and before its end, of the same values of `on`.

    Time is cut into bins of `width` days. An interval has a row for each bin that it reaches into, a point has one, so
    an equi-join on bin meets each pair once: no pair is made that lies over a bin apart, and a busy value of `on` is
    spread over its bins. A width about the usual length gives two rows an interval. Intervals without both ends, of no
    length, or that end before they begin hold nothing; null values of `on` meet nothing. Columns of points other than
    `on` and `at` keep their names, and must not be names of intervals' columns.
    """
    days = lambda c: F.floor(number(c) / width)
    spans = intervals.where(F.col(start) < F.col(end)).withColumn("_bin", F.explode(F.sequence(days(F.col(start)), days(F.date_sub(F.col(end), 1)))))
    placed = points.withColumn("_bin", days(F.col(at)))
    return spans.join(placed, [*on, "_bin"]).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_bin")


def counted_within(intervals: DataFrame, points: DataFrame, start: str, end: str, at: str, width: int, on: list[str], key: list[str], name: str = "n") -> DataFrame:
    """(key, name): how many points fall within each interval, 0 where none does; key tells the intervals apart, and has
    no nulls. Points are counted by day first, so that a busy day is one row."""
    daily = points.groupBy(*on, at).agg(F.count("*").alias("_points"))
    found = points_within(intervals.select(*dict.fromkeys([*key, *on, start, end])), daily, start, end, at, width, on).groupBy(*key).agg(F.sum("_points").alias(name))
    return intervals.select(*key).join(found, key, "left").na.fill(0, [name])


def coverage(intervals: DataFrame, on: list[str], start: str, end: str) -> DataFrame:
    """Of each value of `on`: leases, busy (days that some lease covers), spells (runs of days without a gap), longest_gap
    (days between spells, 0 with one spell), and most (leases at once).

    Changes are summed by day before any window, so a value's window holds its days, not its leases. Leases that touch
    are one spell; those without both ends or of no length are left out.
    """
    fine = intervals.where(F.col(start) < F.col(end))
    change = fine.select(*on, F.explode(F.array(F.struct(F.col(start).alias("day"), F.lit(1).alias("opens"), F.lit(1).alias("by")), F.struct(F.col(end).alias("day"), F.lit(0).alias("opens"), F.lit(-1).alias("by")))).alias("c"))
    daily = change.groupBy(*on, F.col("c.day").alias("day")).agg(F.sum("c.by").alias("by"), F.sum("c.opens").alias("opens"))
    order = Window.partitionBy(*on).orderBy("day")
    open_ = daily.withColumn("open", F.sum("by").over(order)).withColumns({"next": F.lead("day").over(order), "before": F.lag("open").over(order)})
    length = F.datediff("next", "day")
    none = F.lit(0).cast("long")
    return open_.groupBy(*on).agg(
        F.sum("opens").alias("leases"),
        F.coalesce(F.sum(F.when(F.col("open") > 0, length)), none).cast("long").alias("busy"),
        F.count_if((F.col("open") > 0) & (F.coalesce("before", F.lit(0)) == 0)).alias("spells"),
        F.coalesce(F.max(F.when((F.col("open") == 0) & F.col("next").isNotNull(), length)), F.lit(0)).cast("long").alias("longest_gap"),
        F.max("open").alias("most"),
    )
