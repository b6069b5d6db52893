"""Predicates, projections, orders, sets, dates and small functions of records (P1-P4, P6-P10, P12, P13, P16, O1-O8,
O10, U1, U3, U5, N5-N8, D1-D6, D8, D9, W16, W17)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examlake.functions import text as T
from examlake.operators.sampling import hashed


def matching(rows: DataFrame, equal: dict[str, object], among: dict[str, list] | None = None, filled: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose columns equal the given values (None: any), are in the given lists, and are filled."""
    tests = [F.col(c) == v for c, v in equal.items() if v is not None]
    tests += [F.col(c).isin(*v) for c, v in (among or {}).items()] + [is_filled(F.col(c)) for c in filled]
    return rows.where(reduce(lambda a, b: a & b, tests, F.lit(True)))


def is_filled(text: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(text, F.lit("")) != ""


def with_prefix(text: Column, prefix: str) -> Column:
    """Texts that begin so, _ and % standing for themselves (P4; LIKE would take them for wildcards)."""
    return F.startswith(text, F.lit(prefix))


def first_filled(*texts: Column) -> Column:
    """The first text that is neither null nor empty, else an empty one."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts], F.lit(""))


def first_sized(*values: Column) -> Column:
    """The first array or map that holds anything, or null."""
    return F.coalesce(*[F.when(F.size(v) > 0, v) for v in values])


def first_nonzero(*numbers: Column) -> Column:
    """The first number that is neither null nor zero, else zero."""
    return F.coalesce(*[F.nullif(n, F.lit(0)) for n in numbers], F.lit(0))


def with_defaults(rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Nulls of the named columns filled; empty values stay."""
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def canonical(rows: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """These fields alone, in this order, empty where null (P8); strings."""
    return rows.select(*[F.coalesce(c.cast("string"), F.lit("")).alias(name) for name, c in fields.items()])


def safe_json(fields: dict[str, Column]) -> Column:
    """JSON of the named fields alone, keys sorted, nulls left out, letters of any script as they are."""
    return F.to_json(F.struct(*[c.alias(name) for name, c in sorted(fields.items())]))


def subject_ids(key: Column) -> Column:
    """Whether a key is S and two digits."""
    return key.rlike(r"^S\d{2}$")


def outside_subjects(key: Column, subjects: tuple[str, ...] = (), modules: tuple[str, ...] = ()) -> Column:
    """Whether neither the subject nor the module part of a key is excluded."""
    module = F.substring_index(key, "-", 2)
    return ~T.key_subject(key).isin(*subjects) & ~module.isin(*modules)


def truncated(text: Column, n: int) -> Column:
    """The first n characters."""
    return F.substring(text, 1, n)


def oldest(rows: DataFrame, order: list[str], key: str, n: int | None = None) -> DataFrame:
    """The first n rows by order; ties by key, so that reruns agree."""
    sorted_ = rows.orderBy(*order, key)
    return sorted_ if n is None else sorted_.limit(n)


def by_time(rows: DataFrame, text: str, key: str, n: int) -> DataFrame:
    """The first n rows by a time kept as text; texts that are no time come first (O3)."""
    return rows.orderBy(F.col(text).try_cast("timestamp").asc_nulls_first(), key).limit(n)


def declared_order(key: Column, first: list[str], rest: list[str]) -> Column:
    """Place of a key: those in first, then those in rest, then all others."""
    places = {k: i for i, k in enumerate(dict.fromkeys([*first, *rest]))}
    return reduce(lambda c, k: c.when(key == k, places[k]), places, F.when(F.lit(False), 0)).otherwise(len(places))


def suffix_number(key: Column) -> Column:
    """The number after a key's first letter, to sort by."""
    return F.substring(key, 2, 20).try_cast("int")


def due(queue: DataFrame, ready_at: str, key: str, now: Column) -> DataFrame:
    """Delayed items whose time has come, in order of time."""
    return queue.where(F.col(ready_at) <= now).orderBy(ready_at, key)


def best_available(workers: DataFrame, group: list[str], name: str, weight: str, free: Column) -> DataFrame:
    """The free worker of the highest weight in each group, ties to the smaller name."""
    order = Window.partitionBy(*group).orderBy(F.desc(weight), name)
    return workers.where(free).withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows by hash order: the same for the same seed."""
    return rows.orderBy(hashed(F.col(key), seed), key).limit(n)


def page(rows: DataFrame, order: list[str], size: int, number: int) -> DataFrame:
    """The number-th page of size rows, from 0 (W16). Depth costs a sort of all rows before it, as offsets do."""
    return rows.orderBy(*order).offset(size * number).limit(size)


def known_texts(rows: DataFrame, group: list[str], order: str, text: str, n: int = 20, width: int = 50) -> DataFrame:
    """The first n texts of each group, cut to width, as a list (W17): bounded before it is collected."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(order))
    top = rows.withColumn("_rank", rank).where(F.col("_rank") <= n)
    return top.groupBy(*group).agg(F.transform(F.sort_array(F.collect_list(F.struct("_rank", truncated(F.col(text), width).alias("t")))), lambda x: x["t"]).alias("texts"))


def distinct_in_order(values: Column) -> Column:
    """Values once each, by their text, in order of first occurrence."""
    return F.array_distinct(F.transform(values, lambda v: v.cast("string")))


def errors_of(*kinds: tuple[str, DataFrame]) -> DataFrame:
    """Errors of several kinds in one table, with their kind; columns that a kind lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("error", F.lit(kind)) for kind, df in kinds])


def overlay(base: Column, over: Column) -> Column:
    """A map with another's entries in place of, and beside, its own."""
    kept = F.map_filter(F.coalesce(base, F.create_map().cast("map<string,string>")), lambda k, _: ~F.coalesce(F.map_contains_key(over, k), F.lit(False)))
    return F.map_concat(kept, F.coalesce(over, F.create_map().cast("map<string,string>")))


def iso_seconds(ts: Column) -> Column:
    """A time as ISO text to the second, with the zone of the session."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def elapsed(start: Column, end: Column) -> Column:
    """Hours and minutes between two times."""
    minutes = F.floor((F.unix_timestamp(end) - F.unix_timestamp(start)) / 60)
    return F.concat(F.floor(minutes / 60).cast("string"), F.lit("h"), F.pmod(minutes, F.lit(60)).cast("string"), F.lit("m"))


def short_id(*parts: Column) -> Column:
    """16 hex digits that depend on the parts alone, so that reruns agree (D3)."""
    return F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 16)


def backoff(attempt: Column, kind: str = "linear") -> Column:
    """Seconds to wait before the next attempt, from 0: 5, 10 .. 30; 5, 10, 20 .. 60; or 60, 120, 240."""
    if kind == "linear":
        return F.least(F.lit(30), 5 * (attempt + 1)).cast("int")
    if kind == "doubling":
        return F.least(F.lit(60), 5 * F.pow(F.lit(2), F.least(attempt, F.lit(20)))).cast("int")
    return F.element_at(F.array(F.lit(60), F.lit(120), F.lit(240)), F.least(F.greatest(attempt, F.lit(0)), F.lit(2)).cast("int") + 1)


def held(value: Column, low: float, high: float) -> Column:
    """A value held between two bounds."""
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def load_weight(success: Column, latency: Column, in_flight: Column) -> Column:
    """Share of work for a provider: less if slow or busy, 0.1 at least and below half success."""
    w = success * 10.0 / F.when(latency > 0, 1 + latency / 30.0).otherwise(F.lit(1.0)) / (1 + in_flight * 2)
    return F.when(success < 0.5, 0.1).otherwise(F.greatest(F.lit(0.1), w))
