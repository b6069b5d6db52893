"""The production line as runs over an event store: stages, admission, retries, recovery, monitors and milestones (ST1,
ST3-ST6, ST8, ST9, ST13, ST14)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from examlake.operators import running
from examlake.operators.select import backoff

STORE = "record_id string, status string, seq long, detail string"


def stage(spark: SparkSession, store: str, name: str, taken: str, step: Callable[[DataFrame], DataFrame], files: int = 100) -> int:
    """One stage over everything that has arrived, then stop (ST1, ST7): events of the taken status go through step,
    and what it returns is added to the store. Says how many rows it added.

    Each batch writes a folder of its own under its number, so that a batch which is run again after a failure writes
    the same place. The line has loops; a stage that finds new events is simply run again.
    """
    added = 0

    def write(batch: DataFrame, number: int) -> None:
        nonlocal added
        path = f"{store}/{name}-{number:09d}"
        step(batch).select("record_id", "status", "seq", "detail").write.mode("overwrite").parquet(path)
        added += spark.read.parquet(path).count()

    events = spark.readStream.schema(STORE).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(store)
    query = events.where(F.col("status") == taken).writeStream.foreachBatch(write).trigger(availableNow=True).option("checkpointLocation", f"{store}-checkpoints/{name}").start()
    query.awaitTermination()
    return added


def drained(spark: SparkSession, store: str, stages: list[tuple[str, str, Callable[[DataFrame], DataFrame]]], rounds: int = 10) -> int:
    """Runs all stages round by round until none adds an event; how many rounds that took (ST1, ST7).

    A line that still moves after so many rounds is an error, not a result."""
    for n in range(1, rounds + 1):
        if not sum(stage(spark, store, name, taken, step) for name, taken, step in stages):
            return n
    raise RuntimeError(f"the line is not empty after {rounds} rounds")


def with_regeneration(rows: DataFrame, failed: Column, passed_to: str, most: int = 2) -> DataFrame:
    """Next event of each row: passed_to, or REGENERATE with its round in detail, and DISCARDED after most rounds (ST1)."""
    n = F.coalesce(F.regexp_extract(F.coalesce("detail", F.lit("")), r"round=(\d+)", 1).try_cast("int"), F.lit(0))
    status = F.when(~failed, passed_to).when(n < most, "REGENERATE").otherwise("DISCARDED")
    return rows.select("record_id", status.alias("status"), (F.col("seq") + 1).alias("seq"), F.when(failed, F.concat(F.lit("round="), (n + 1).cast("string"))).otherwise(F.col("detail")).alias("detail"))


def admitted(waiting: DataFrame, group: list[str], order: list[str], room: Column) -> DataFrame:
    """admitted: whether a waiting item finds room in its queue, by order; the others are deferred (ST3). Queues may be
    of any length."""
    return running.numbered(waiting, group, order, "_place").withColumn("admitted", F.col("_place") <= room).drop("_place")


# Reviewers and generators at work in each zone of queue fill.
SLOTS = ((12, 32), (12, 24), (12, 16), (8, 8), (8, 8))


def slots_of(zone: Column, image_fill: Column, most_images: int = 38) -> Column:
    """struct<review, generate, image> slots by zone, image slots by their own queue (ST4)."""
    of = lambda k: F.element_at(F.array(*[F.lit(s[k]) for s in SLOTS]), F.least(zone, F.lit(len(SLOTS) - 1)).cast("int") + 1)
    image = F.when(image_fill < 0.05, max(1, most_images // 4)).when(image_fill < 0.15, max(most_images // 2, most_images * 2 // 3)).otherwise(most_images)
    return F.struct(of(0).alias("review"), of(1).alias("generate"), image.alias("image"))


def retry_plan(failures: DataFrame, key: str, order: str, ts: str, most: int = 3) -> DataFrame:
    """attempt, retry_at and status of technical failures: RETRY after 5, 10 and 15 seconds, then HOLD (ST5)."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(order))
    again = F.col("attempt") <= most
    wait = F.make_dt_interval(secs=backoff(F.col("attempt") - 1).cast("decimal(18,6)"))
    return failures.withColumn("attempt", n).withColumns({"status": F.when(again, "RETRY").otherwise("HOLD"), "retry_at": F.when(again, F.col(ts) + wait)})


def retried(key: tuple[str], batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """State of one record: how many technical failures it has had; a timer brings a retry when it is due (ST5)."""
    if state.hasTimedOut:
        n = state.get[0]
        state.update((n,))
        yield pd.DataFrame({"record_id": [key[0]], "attempt": [n], "status": ["RETRY"]})
        return
    n = state.get[0] if state.exists else 0
    n += sum(len(t) for t in batches)
    state.update((n,))
    if n > 3:
        yield pd.DataFrame({"record_id": [key[0]], "attempt": [n], "status": ["HOLD"]})
    else:
        state.setTimeoutDuration(1000 * min(30, 5 * n))
        yield pd.DataFrame({"record_id": [key[0]], "attempt": [n], "status": ["WAIT"]})


def retries(failures: DataFrame) -> DataFrame:
    """Delayed retries of a stream of failures (record_id): WAIT when one is noted, RETRY when its time has come, HOLD
    after the third (ST5)."""
    return failures.groupBy("record_id").applyInPandasWithState(retried, "record_id string, attempt long, status string", "n long", "append", "ProcessingTimeTimeout")


def recovery(records: DataFrame, order: list[str], key: str, most: int = 500) -> DataFrame:
    """Where unfinished records go on after a restart: GENERATED to review, ACCEPTED to image, the oldest most of each (ST6)."""
    to = F.when(F.col("status") == "GENERATED", "review").when(F.col("status") == "ACCEPTED", "image")
    place = F.row_number().over(Window.partitionBy("queue").orderBy(*order, key))
    return records.withColumn("queue", to).where("queue is not null").withColumn("_place", place).where(F.col("_place") <= most).drop("_place")


def watched(key: tuple[str], batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """The last five snapshots of a line: stalled if they are alike and its queue is high (ST8)."""
    last = list(state.get[0]) if state.exists else []
    out = []
    for t in batches:
        for r in t.sort_values("ts").itertuples():
            last = [*last, f"{r.total_pass}|{r.total_reviewed}"][-5:]
            out.append((key[0], r.ts, len(last) == 5 and len(set(last)) == 1 and bool(r.review_fill >= 0.85)))
    state.update((last,))
    yield pd.DataFrame(out, columns=["line", "ts", "stalled"])


def stall_monitor(snapshots: DataFrame) -> DataFrame:
    """stalled for each snapshot of a stream (line, ts, total_pass, total_reviewed, review_fill) (ST8)."""
    return snapshots.groupBy("line").applyInPandasWithState(watched, "line string, ts timestamp, stalled boolean", "last array<string>", "append", "NoTimeout")


def milestones(spark: SparkSession, passes: DataFrame, folder: str, checkpoint: str, every: int = 100, stop: int = 24_000) -> None:
    """A row for each multiple of every that the count of passes reaches, and one for stop (ST9), each once.

    A batch writes its count under its number, over what a failed run of the same batch may have left; milestones are
    what the counts before and with it pass by."""

    def write(batch: DataFrame, number: int) -> None:
        batch.agg(F.count("*").alias("n")).withColumn("batch", F.lit(number).cast("long")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/counts/{number:09d}")
        counts = spark.read.schema("n long, batch long").option("recursiveFileLookup", "true").parquet(f"{folder}/counts")
        before, now = counts.agg(F.coalesce(F.sum(F.when(F.col("batch") < number, F.col("n"))), F.lit(0)), F.coalesce(F.sum(F.when(F.col("batch") <= number, F.col("n"))), F.lit(0))).first()  # one number a batch
        first, last = before // every + 1, now // every
        steps = spark.range(first * every, last * every + 1, every).select(F.col("id").alias("milestone"), F.lit("sample").alias("action")) if last >= first else spark.createDataFrame([], "milestone long, action string")
        if before < stop <= now:
            steps = steps.unionByName(spark.range(stop, stop + 1).select(F.col("id").alias("milestone"), F.lit("stop").alias("action")))
        steps.coalesce(1).write.mode("overwrite").parquet(f"{folder}/milestones/{number:09d}")

    passes.writeStream.foreachBatch(write).trigger(availableNow=True).option("checkpointLocation", checkpoint).start().awaitTermination()


def period_report(events: DataFrame, ts: str, value: str, minutes: int = 15) -> DataFrame:
    """Counts of every period from the first event to the last, with heartbeat where nothing happened (ST13)."""
    width = minutes * 60
    start = lambda c: F.timestamp_seconds(F.floor(F.unix_timestamp(c.cast("timestamp")) / width) * width)
    bounds = events.agg(F.min(start(F.col(ts))).alias("a"), F.max(start(F.col(ts))).alias("z"))
    grid = bounds.where("a is not null").select(F.explode(F.sequence("a", "z", F.expr(f"interval {minutes} minutes"))).alias("start"))
    counts = events.groupBy(start(F.col(ts)).alias("start")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return grid.join(counts, "start", "left").select("start", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("total", F.lit(0.0)).alias("total"), F.col("n").isNull().alias("heartbeat"))


def fanned_out(rows: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, parts: int) -> DataFrame:
    """work done on batches of rows by parts tasks side by side; results come as they are done (ST14)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            yield work(t)

    return rows.repartition(parts).mapInPandas(run, schema)
