"""Counts and rates for dashboards and alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examlake.functions import text as T
from examlake.functions.variants import holds, kind, let, part, whole


def progress_count(records: DataFrame, keys: list[str], status: str, done: list[str], mode: str = "done") -> DataFrame:
    """Progress per key: records of a done status, or all of them (A3, A4); no keys count all records as one."""
    counted = F.count_if(F.col(status).isin(*done)) if mode == "done" else F.count("*")
    return records.groupBy(*keys).agg(counted.alias("progress"))


def failure_class(note: Column, status: Column) -> Column:
    """Kind of failure, the first rule that holds; null if none does (A10)."""
    low = F.lower(F.coalesce(note, F.lit("")))
    has = lambda *parts: reduce(lambda a, b: a | b, [F.contains(low, F.lit(p)) for p in parts])
    return (
        F.when(has("qwen_technical", "technical_failure"), "technical failure")
        .when(has("candidate_quality_fail"), "too easy")
        .when(has("render") & has("fail"), "render failure")
        .when(status.isin("SENTINEL_REGEN", "REGENERATE", "REPAIR_PENDING"), "pending")
        .when(status == "HOLD", "hold")
    )


def most_common(rows: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Values by count, the largest first, ties to the smaller value."""
    out = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
    return out if n is None else out.limit(n)


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    """Per cent of a whole, rounded; 0 where there is no whole."""
    return F.when(whole == 0, 0.0).otherwise(F.round(100.0 * part / whole, digits))


def summary(records: DataFrame, status: str, wrong: str, correct: str, note: str) -> DataFrame:
    """All counters of a dashboard in one pass (A14): records, passes, render failures, scores, technical failures."""
    s, w, c = F.col(status), F.col(wrong), F.col(correct)
    low = F.lower(F.coalesce(note, F.lit("")))
    technical = F.contains(low, F.lit("qwen_technical")) | F.contains(low, F.lit("technical_failure"))
    return records.agg(
        F.count("*").alias("total"), F.count_if(s == "FINAL_PASS").alias("final_pass"), F.count_if(s.isin("RENDER_FAIL", "RENDER_FAILED")).alias("render_fail"), F.count_if(s == "HOLD").alias("hold"),
        F.count_if(s.isin("SENTINEL_REGEN", "REGENERATE", "REPAIR_PENDING")).alias("pending"), F.count(w).alias("scored"), F.count_if(w >= 3).alias("hard_enough"),
        F.count_if(~F.coalesce(w >= 3, F.lit(False)) & w.isNotNull() & (c >= 3)).alias("too_easy"), F.count_if(technical).alias("technical"), F.coalesce(F.sum(w), F.lit(0)).alias("wrong_answers"),
        F.coalesce(F.sum(c), F.lit(0)).alias("right_answers"), F.count_if(s.isNull()).alias("unknown"),
    )


def difficulty(record: Column, paths: tuple[str, ...] = ("$.difficulty", "$.difficulty_level", "$.metadata.difficulty")) -> Column:
    """A whole number at the first path of a JSON text whose value is not null, empty, zero or false; null if that value
    is no whole number, or a text of one (A15). The text is parsed once."""

    def found(v: Column) -> Column:
        return F.coalesce(*[let(part(v, p), lambda x: F.when(holds(x), x)) for p in paths])

    def number(v: Column) -> Column:
        return F.when(kind(v).isin("BIGINT", "STRING"), T.stripped(F.try_variant_get(v, "$", "string")).try_cast("int"))

    return let(whole(record), lambda v: let(found(v), number))


def added(counts: list[DataFrame], bin_: str, n: str = "n") -> DataFrame:
    """Counts of several sources added bin by bin."""
    return reduce(lambda a, b: a.unionByName(b), [c.select(bin_, n) for c in counts]).groupBy(bin_).agg(F.sum(n).alias(n))


def lists(rows: DataFrame, group: str, order: list[str], value: str, part: int = 1000) -> DataFrame:
    """Values of each group in order, as lists of part values, numbered (A19): a group of any size makes as many rows
    as it needs, none of which is unbounded."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1
    cut = rows.withColumns({"_place": place}).withColumn("part", F.floor(F.col("_place") / part).cast("int"))
    each = F.sort_array(F.collect_list(F.struct("_place", F.col(value).alias("v"))))
    return cut.groupBy(group, "part").agg(F.transform(each, lambda x: x["v"]).alias("values"))


def health(calls: DataFrame, group: str, order: str, ok: Column, latency: str, whole: Column, width: int = 50) -> DataFrame:
    """Per provider: success and completeness rates (1 without calls), mean and 95th percentile of its last width
    latencies, by index, the mean below five (A20)."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(order)))
    recent = F.when(F.col("_rank") <= width, F.col(latency))
    out = calls.withColumn("_rank", rank).groupBy(group).agg(F.coalesce(F.avg(ok.cast("double")), F.lit(1.0)).alias("success"), F.coalesce(F.avg(whole.cast("double")), F.lit(1.0)).alias("complete"), F.avg(recent).alias("mean"), F.sort_array(F.collect_list(recent)).alias("_v"))  # width values at most
    n = F.size("_v")
    at = F.least(F.floor(n * 0.95).cast("int") + 1, n)
    return out.withColumn("p95", F.when(n < 5, F.col("mean")).otherwise(F.try_element_at("_v", at))).drop("_v")


def blocked(probes: DataFrame, ok: Column, most: float = 0.30) -> DataFrame:
    """Probes, failures, their rate, and whether it blocks a start; no probes block too."""
    out = probes.agg(F.count("*").alias("probes"), F.count_if(~ok).alias("failed"))
    rate = F.try_divide(F.col("failed"), F.col("probes"))
    return out.select("*", rate.alias("rate"), F.coalesce(rate > most, F.lit(True)).alias("blocked"))


def sampling_report(records: DataFrame, group: str, counted: dict[str, Column], engine: str) -> DataFrame:
    """Per group the named counts, and a map of its engines' counts."""
    by_engine = records.groupBy(group, engine).agg(F.count("*").alias("_n"), *[F.count_if(c).alias(k) for k, c in counted.items()])
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce(engine, F.lit("none")), "_n"))))  # one entry an engine
    return by_engine.groupBy(group).agg(F.sum("_n").alias("generated"), *[F.sum(k).alias(k) for k in counted], entries.alias("engines"))


def differences(counts: DataFrame, expected: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Keys whose count is not the expected one, either side missing counting as 0."""
    both = counts.select(key, F.col(n).alias("actual")).join(expected.select(key, F.col(n).alias("expected")), key, "full")
    return both.select(key, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("actual", "expected")]).where("actual <> expected")


def small_files(files: DataFrame, length: str = "length", small: int = 4096, most: float = 0.20, least: int = 50) -> DataFrame:
    """Files, small ones, and whether their rate is over most, once there are more than least files."""
    out = files.agg(F.count("*").alias("files"), F.count_if(F.col(length) <= small).alias("small"))
    return out.withColumn("alert", (F.col("files") > least) & (F.col("small") > most * F.col("files")))


#: Patterns of log lines and how many of each are borne.
ALERTS = {"glyph": ("Glyph.*missing", 0), "blank": ("空白图片", 5), "traceback": ("Traceback|RuntimeError|MemoryError|OSError|Segmentation", 0), "api": ("401|403|500|502|503", 3), "timeout": ("timed out|Timeout", 5)}


def log_alerts(lines: DataFrame, text: str, alerts: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    """(alert, n, raised): lines that match each pattern, in one pass over them."""
    known = alerts or ALERTS
    one = lines.agg(*[F.count_if(F.col(text).rlike(p)).alias(k) for k, (p, _) in known.items()])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("alert"), F.col(k).alias("n"), (F.col(k) > most).alias("raised")) for k, (_, most) in known.items()]))
    return one.select(each.alias("a")).select("a.*")


def throughput(done: Column, seconds: Column, target: Column) -> Column:
    """struct<per_hour, hours_left>: 0 and null in the first minute or without progress."""
    rate = F.when(seconds >= 60, done / (seconds / 3600.0)).otherwise(0.0)
    return F.struct(rate.alias("per_hour"), F.when((done > 0) & (seconds >= 60), (target - done) / rate).alias("hours_left"))


def ready(passed: Column, points: Column) -> Column:
    """READY from 95 per cent of a subject's points on."""
    return F.when(passed >= points * 0.95, "READY").otherwise("PARTIAL")


def backpressure(queue: Column, active: Column, per_hour: float = 720.0, most: float = 2.0) -> Column:
    """struct<ratio, active>: queue against half of what active reviewers do in an hour."""
    ratio = queue / F.greatest(F.lit(1.0), active * per_hour / 2)
    return F.struct(F.round(ratio, 2).alias("ratio"), (ratio > most).alias("throttle"))


def scale(success: DataFrame, rate: str, queue: Column, up: float = 95.0, down: float = 80.0, least_queue: int = 3) -> DataFrame:
    """mean of providers' success in per cent, and up, down or stay."""
    mean = success.agg(F.avg(rate).alias("mean"))
    return mean.withColumn("scale", F.when((F.col("mean") >= up) & (queue > least_queue), "up").when(F.col("mean") < down, "down").otherwise("stay"))


def taxonomy_sizes(taxonomy: DataFrame, subjects: int = 24) -> DataFrame:
    """Modules and knowledge points of each subject, and whether there are as many subjects as there should be."""
    points = F.aggregate(F.transform("modules", lambda m: F.size(m["knowledge_points"])), F.lit(0), lambda a, n: a + F.greatest(n, F.lit(0)))
    total = F.count("*").over(Window.partitionBy())  # one row a subject
    return taxonomy.select("subject_id", F.greatest(F.size("modules"), F.lit(0)).alias("modules"), F.coalesce(points, F.lit(0)).alias("points"), (total == subjects).alias("complete"))


def taxonomy_counts(points: DataFrame, subject: str, module: str, point: str, subjects: int = 24) -> DataFrame:
    """The same of a flat table, a row a point: counted by module within tasks, nothing is collected; modules without
    points have a row without one, and so have subjects without modules."""
    modules = points.groupBy(subject, module).agg(F.count(point).alias("points"))
    sizes = modules.groupBy(F.col(subject).alias("subject_id")).agg(F.count(module).cast("int").alias("modules"), F.sum("points").cast("int").alias("points"))
    return sizes.withColumn("complete", F.count("*").over(Window.partitionBy()) == subjects)  # one row a subject


def counters(events: DataFrame, name: str, by: Column) -> DataFrame:
    """Running totals keyed by the event's name."""
    return events.groupBy(name).agg(F.sum(by).alias("total"))


def no_growth(snapshots: DataFrame, group: list[str], ts: str, value: str, least: int = 600) -> DataFrame:
    """seconds since value last rose above all before it, and whether that is least or more (W10); of rows of one time,
    the smaller value comes first."""
    order = Window.partitionBy(*group).orderBy(ts, value)
    before = F.max(value).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rose = F.when(before.isNull() | (F.col(value) > before), F.col(ts))
    out = snapshots.withColumn("_rose", rose).withColumn("_last", F.last("_rose", ignorenulls=True).over(order))
    seconds = F.unix_timestamp(F.col(ts).cast("timestamp")) - F.unix_timestamp(F.col("_last").cast("timestamp"))
    return out.withColumn("seconds", seconds).withColumn("stalled", F.col("seconds") >= least).drop("_rose", "_last")


def overall_accuracy(items: DataFrame) -> DataFrame:
    """Accuracy over all answers, and shares of items with all and with most answers right (A8); items: majority()."""
    return items.agg(F.round(F.try_divide(F.sum("c"), F.sum("n")), 6).alias("accuracy"), F.round(F.avg(F.col("all_correct").cast("double")), 6).alias("all_correct"), F.round(F.avg(F.col("majority").cast("double")), 6).alias("majority"))


