"""Numbers and sums along an order in groups of any size: no task holds a group (W1-W3, ST3, K1)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examlake.sources.scratch import written

#: Bits of a row's place within its partition.
PLACE = 33


def numbered(rows: DataFrame, group: list[str], order: list[str | Column], name: str = "n", total: str | None = None) -> DataFrame:
    """rows with their number from 1 on in each group, by order; total: also the group's size, under that name.

    Rows are range-partitioned by group and order, sorted in their tasks and written with their place. Of each
    partition and group, the first place and the count are all that is needed of it: a small table, as partitions hold
    runs of the order. Its running sums give what is added to a place. So a group of any size is dealt over as many
    tasks as its rows fill. Null group values are a group; rows that are alike in group and order are numbered in any
    order, once. An empty table gives none.
    """
    place, part, first, before, n = (f"_{x}_{uuid.uuid4().hex}" for x in ("place", "part", "first", "before", "n"))
    keys = [F.col(c).asc_nulls_first() for c in group]
    by = [*keys, *order]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    held = written(dealt.withColumn(place, F.monotonically_increasing_id()), "numbered").withColumn(part, F.shiftright(place, PLACE))
    runs = held.groupBy(part, *group).agg(F.min(place).alias(first), F.count("*").alias(n))
    own = Window.partitionBy(*group)
    # A group's runs are as many as the partitions that it reaches over.
    sums = runs.select(part, *group, first, (F.sum(n).over(own.orderBy(part)) - F.col(n)).alias(before), *([F.sum(n).over(own).alias(total)] if total else []))
    a, b = held.alias("a"), sums.alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{part}") == F.col(f"b.{part}"), *(F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in group)])
    number = (F.col(f"a.{place}") - F.col(f"b.{first}") + F.col(f"b.{before}") + 1).alias(name)
    return a.join(b, same).select(*(F.col(f"a.{c}") for c in rows.columns), number, *([F.col(f"b.{total}")] if total else []))
