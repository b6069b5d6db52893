"""Provider health and delayed retries with several state variables, timers and TTL (W6, ST5).

transformWithStateInPandas keeps its state in RocksDB: the session's state store provider must be the RocksDB one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from examlake.streaming.jobs import FRESH, advanced

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HEALTH = "key string, errors long, seen long, status string, kinds long, p95 double, cause string"
#: Latencies that the 95th percentile is taken of.
LATENCIES = 50


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class Health(StatefulProcessor):
    """One provider: its state machine (a value), its last latencies (a list), kinds of calls seen (a map), and
    a timer that ends a cooldown though no call comes.

    Input: key, ts, event_id, kind (error is a failed call), value (latency). A row goes out for each batch of calls
    (cause calls), and one when a timer ends a cooldown (cause timer). Calls of a batch are taken in order of time and
    id. Initial state (key, run, good, bad, status, until) is where a provider begins.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.machine = handle.getValueState("machine", "run long, good long, bad long, status string, until double")
        self.latencies = handle.getListState("latencies", "value double")
        self.kinds = handle.getMapState("kinds", "kind string", "n long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        r = initialState.iloc[0]
        self.machine.update((int(r["run"]), int(r["good"]), int(r["bad"]), str(r["status"]), float(r["until"])))
        self._timers(str(r["status"]), float(r["until"]))

    def _timers(self, status: str, until: float) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if status == "COOLDOWN":
            self.handle.registerTimer(int(until * 1000))

    def _row(self, key, now: tuple, cause: str) -> pd.DataFrame:
        held = sorted(x[0] for x in self.latencies.get()) if self.latencies.exists() else []
        kinds = sum(1 for _ in self.kinds.keys()) if self.kinds.exists() else 0
        p95 = held[min(int(len(held) * 0.95), len(held) - 1)] if held else None
        return pd.DataFrame({"key": [key[0]], "errors": [now[0]], "seen": [now[1] + now[2]], "status": [now[3]], "kinds": [kinds], "p95": [p95], "cause": [cause]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        calls = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        now = tuple(self.machine.get()) if self.machine.exists() else FRESH
        for r in calls.itertuples():
            now = advanced(now, r.ts.timestamp(), r.kind != "error")
        self.machine.update(now)
        held = [x[0] for x in self.latencies.get()] if self.latencies.exists() else []
        self.latencies.put([(float(x),) for x in [*held, *calls["value"].dropna()][-LATENCIES:]] or [(0.0,)])
        for kind, n in calls["kind"].value_counts().items():
            seen = self.kinds.getValue((kind,))[0] if self.kinds.containsKey((kind,)) else 0
            self.kinds.updateValue((kind,), (int(seen + n),))
        self._timers(now[3], now[4])
        yield self._row(key, now, "calls")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = tuple(self.machine.get())
        if now[3] == "COOLDOWN":
            now = (0, now[1], now[2], "HEALTHY", now[4])
            self.machine.update(now)
            yield self._row(key, now, "timer")

    def close(self) -> None:
        pass


def provider_health(events: DataFrame, initial: DataFrame | None = None, late: str = "10 minutes") -> DataFrame:
    """Health of each key by its calls (W6); timers run on the watermark of ts, so a cooldown ends with
    the time of calls, and a replay gives what the first run gave."""
    grouped = events.withWatermark("ts", late).groupBy("key")
    start = initial.groupBy("key") if initial is not None else None
    return grouped.transformWithStateInPandas(Health(), HEALTH, "update", "eventTime", initialState=start)


class Retry(StatefulProcessor):
    """Failures of one record (ST5): so many seconds after the first, twice and three times as many after the second and
    third, it is due again; the fourth holds it. State: attempts (a value, forgotten `ttl` milliseconds after its last
    change, so that a record that came through begins anew) and a timer for each retry, on the clock."""

    def __init__(self, seconds: float = 5.0, most: int = 3, ttl: int = 86_400_000):
        self.seconds, self.most, self.ttl = seconds, most, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.attempts = handle.getValueState("attempts", "n long", ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, out = self.attempts.get()[0] if self.attempts.exists() else 0, []
        now = timerValues.getCurrentProcessingTimeInMs()
        for _ in range(sum(map(len, rows))):
            n += 1
            due = int(now + 1000 * self.seconds * n)
            if n <= self.most:
                self.handle.registerTimer(due)
            out.append((key[0], n, "WAIT" if n <= self.most else "HOLD", pd.Timestamp(due, unit="ms") if n <= self.most else pd.NaT))
        self.attempts.update((n,))
        yield pd.DataFrame(out, columns=["key", "attempt", "status", "due"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n = self.attempts.get()[0] if self.attempts.exists() else 0
        if n <= self.most:  # a record on hold is not tried again
            yield pd.DataFrame({"key": [key[0]], "attempt": [n], "status": ["RETRY"], "due": [pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")]})

    def close(self) -> None:
        pass


def retries(failures: DataFrame, seconds: float = 5.0, most: int = 3, ttl: int = 86_400_000) -> DataFrame:
    """(key, attempt, status, due): WAIT when a failure (key, ...) comes, RETRY when its time has come, HOLD from the
    fourth on. Times are those of the clock, as a timer of a quiet record must not wait for others' calls;
    so the job runs by a trigger, and an available-now run of it would not end."""
    return failures.groupBy("key").transformWithStateInPandas(Retry(seconds, most, ttl), "key string, attempt long, status string, due timestamp", "append", "processingTime")
