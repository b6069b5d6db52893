"""Incremental jobs over event files: available-now batches, and provider health as keyed state (ST2, ST7, ST10, S9, W6, W15)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENTS = "event_id long, ts timestamp, key string, kind string, value double"


def event_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """New files of a folder; the checkpoint remembers which were read (S9, ST2)."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def period_counts(events: DataFrame, late: str = "30 minutes", period: str = "15 minutes") -> DataFrame:
    """Counts per period and kind, with a watermark for late events."""
    w = F.window("ts", period)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "kind").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "kind", "n", "total")


def exactly_once(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event once, though files repeat it within the watermark; one that comes later than that is exported again,
    unless the target is read with store.fresh() (ST10)."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


# Errors in a row for each status, the rate that heals, and seconds of a cooldown.
DEGRADED, COOLDOWN, DISABLED, HEALED, COOL = 3, 5, 15, 0.95, 60.0
FRESH = (0, 0, 0, "HEALTHY", 0.0)


def advanced(state: tuple[int, int, int, str, float], ts: float, ok: bool) -> tuple[int, int, int, str, float]:
    """(errors in a row, successes, failures, status, end of cooldown) after one call (W6): a success ends the run and
    heals what is degraded once the rate is over HEALED; errors degrade, cool down and disable; time ends a cooldown."""
    run, good, bad, status, until = state
    if status == "COOLDOWN" and ts >= until:
        run, status = 0, "HEALTHY"
    if ok:
        good += 1
        return 0, good, bad, "HEALTHY" if status == "DEGRADED" and good > HEALED * (good + bad) else status, until
    run, bad = run + 1, bad + 1
    if run >= DISABLED:
        return run, good, bad, "DISABLED", until
    if run >= COOLDOWN:
        return run, good, bad, "COOLDOWN", ts + COOL
    return run, good, bad, "DEGRADED" if run >= DEGRADED else status, until


def health(key: tuple[str], batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Status of one provider by its calls, in order of time and id within a batch."""
    now = state.get if state.exists else FRESH
    for t in batches:
        for r in t.sort_values(["ts", "event_id"]).itertuples():
            now = advanced(now, r.ts.timestamp(), r.kind != "error")
    state.update(now)
    yield pd.DataFrame({"key": [key[0]], "errors": [now[0]], "seen": [now[1] + now[2]], "status": [now[3]]})


def provider_health(events: DataFrame) -> DataFrame:
    return events.groupBy("key").applyInPandasWithState(health, "key string, errors long, seen long, status string", "run long, good long, bad long, status string, until double", "update", "NoTimeout")


def run_available(df: DataFrame, target: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything that has arrived, then stop; a rerun goes on from the checkpoint (ST7)."""
    query = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint).format("parquet").start(target)
    query.awaitTermination()
    return query
