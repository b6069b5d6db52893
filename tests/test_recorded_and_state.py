"""The recorded source as a batch and a stream that resumes; keyed state with timers, TTL, lists, maps and restarts."""

import json
import time
from datetime import datetime, timedelta

import pytest

from examlake.sources import recorded
from examlake.streaming import health
from examlake.streaming.jobs import FRESH, advanced

BODIES = ['{"choices": [{"message": {"content": "A"}}]}', '{"content": [{"text": "B"}]}', '{"choices": []}', '{"error": 1}', "x", "", None, "[1]", '{"choices": [{"message": {"content": null}}]}', '{"choices": [null]}', '{"content": "text"}']
SAID = [("A", "ok"), ("B", "ok"), ("", "empty"), (None, "failed"), (None, "failed"), (None, "failed"), (None, "failed"), (None, "failed"), ("", "empty"), ("", "empty"), ("", "empty")]
T0 = datetime(2024, 1, 1)


def record(spark, path, rows):
    spark.createDataFrame(rows, "item long, idx int, body string").coalesce(1).toPandas().to_parquet(path, row_group_size=4)


def test_batch(spark, tmp_path):
    recorded.register(spark)
    for k in range(3):
        record(spark, tmp_path / f"{k}.parquet", [(k, i, b) for i, b in enumerate(BODIES)])
    record(spark, tmp_path / "_open.parquet", [(9, 0, "")])
    df = spark.read.format("recorded_answers").load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 9  # a task a row group

    assert {(r["item"], r["idx"]): (r["answer"], r["status"]) for r in df.collect()} == {(k, i): SAID[i] for k in range(3) for i in range(len(BODIES))}


def test_stream_resumes(spark, tmp_path):
    recorded.register(spark)
    source, out, check = (str(tmp_path / x) for x in ("source", "out", "check"))
    (tmp_path / "source").mkdir()

    def run():
        df = spark.readStream.format("recorded_answers").load(source)
        df.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(out).awaitTermination()
        return sorted((r["item"], r["idx"]) for r in spark.read.parquet(out).collect())

    record(spark, f"{source}/001.parquet", [(1, i, b) for i, b in enumerate(BODIES)])
    first = run()
    assert first == [(1, i) for i in range(len(BODIES))] and run() == first
    record(spark, f"{source}/002.parquet", [(2, 0, BODIES[0])])
    record(spark, f"{source}/003.parquet", [(3, 0, BODIES[1])])
    assert run() == [*first, (2, 0), (3, 0)]


@pytest.fixture
def rocksdb(spark):
    held = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    health.use_rocksdb(spark)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", held)


def stream(spark, source, schema, apply, out, check, mode):
    """Runs what has arrived, and gives the rows that this run added."""
    found = []

    def take(batch, _):
        found.extend(r.asDict() for r in batch.collect())

    apply(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(source)).writeStream.outputMode(mode).foreachBatch(take).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return found


EVENTS = "event_id long, ts timestamp, key string, kind string, value double"


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps({k: v.isoformat() if isinstance(v, datetime) else v for k, v in r.items()}) + "\n" for r in rows))


def calls(key, first, kinds, start):
    return [{"event_id": first + i, "ts": start + timedelta(seconds=i), "key": key, "kind": k, "value": float(i)} for i, k in enumerate(kinds)]


def test_health_over_a_restart_with_timer_and_initial_state(rocksdb, tmp_path):
    spark, source = rocksdb, tmp_path / "in"
    initial = spark.createDataFrame([("b", 2, 10, 2, "HEALTHY", 0.0), ("c", 5, 0, 5, "COOLDOWN", (T0 + timedelta(seconds=30)).timestamp())], "key string, run long, good long, bad long, status string, until double")
    run = lambda: stream(spark, str(source), EVENTS, lambda e: health.provider_health(e, initial, "0 seconds"), None, str(tmp_path / "check"), "update")
    all_calls = {"a": calls("a", 0, ["view"] * 3 + ["error"] * 4, T0), "b": calls("b", 50, ["error"], T0)}
    put(source, "1", all_calls["a"] + all_calls["b"])
    found = run()
    last = {r["key"]: r for r in found if r["cause"] == "calls"}
    assert (last["a"]["status"], last["a"]["errors"], last["a"]["seen"], last["a"]["kinds"], last["a"]["p95"]) == ("DEGRADED", 4, 7, 2, 6.0)
    assert (last["b"]["status"], last["b"]["errors"], last["b"]["seen"]) == ("DEGRADED", 3, 13)
    # A second run goes on from the state: the fifth error cools down; the time of another key's call ends it.
    put(source, "2", calls("a", 20, ["error"], T0 + timedelta(seconds=8)))
    found = run()
    assert [r["status"] for r in found if r["key"] == "a" and r["cause"] == "calls"] == ["COOLDOWN"]
    put(source, "3", calls("z", 90, ["view"], T0 + timedelta(seconds=200)))
    put(source, "4", calls("z", 91, ["view"], T0 + timedelta(seconds=300)))
    found = run()
    assert {r["key"]: (r["status"], r["errors"]) for r in found if r["cause"] == "timer"}["a"] == ("HEALTHY", 0)
    put(source, "5", calls("a", 30, ["error", "view"], T0 + timedelta(seconds=400)))
    found = run()
    # The replay in one go says the same.
    now = FRESH
    for r in [*all_calls["a"], *calls("a", 20, ["error"], T0 + timedelta(seconds=8)), *calls("a", 30, ["error", "view"], T0 + timedelta(seconds=400))]:
        now = advanced(now, r["ts"].timestamp(), r["kind"] != "error")
    end = next(r for r in found if r["key"] == "a" and r["cause"] == "calls")
    assert (end["status"], end["errors"], end["seen"]) == (now[3], now[0], now[1] + now[2])


def until(spark, tmp_path, wanted, seconds=1.0, ttl=600_000):
    """Runs the job by a trigger until a test of its rows holds, and stops it; the rows of this run."""
    found = []

    def take(batch, _):
        found.extend((r["key"], r["attempt"], r["status"]) for r in batch.collect())

    failures = spark.readStream.schema("key string, ts timestamp").json(str(tmp_path / "in"))
    query = health.retries(failures, seconds, 3, ttl).writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="300 milliseconds").start()
    try:
        end = time.time() + 40
        while time.time() < end and not wanted(found) and query.isActive:
            time.sleep(0.2)
    finally:
        query.stop()
    assert wanted(found), (found, query.exception())
    return found


def test_retries_wait_and_hold_over_restarts(rocksdb, tmp_path):
    put(tmp_path / "in", "1", [{"key": "r", "ts": T0}])
    assert ("r", 1, "WAIT") in until(rocksdb, tmp_path, bool, 3.0)
    # The timer is kept over a restart; the first batch after one begins with the first row of any record.
    put(tmp_path / "in", "1b", [{"key": "other", "ts": T0}])
    assert set(until(rocksdb, tmp_path, lambda f: len(f) > 1, 3.0)[:2]) == {("other", 1, "WAIT"), ("r", 1, "RETRY")}
    put(tmp_path / "in", "2", [{"key": "r", "ts": T0}] * 3)
    assert [x for x in until(rocksdb, tmp_path, lambda f: sum(x[0] == "r" for x in f) > 2, 3.0) if x[0] == "r"][:3] == [("r", 2, "WAIT"), ("r", 3, "WAIT"), ("r", 4, "HOLD")]


def test_attempts_are_forgotten(rocksdb, tmp_path):
    put(tmp_path / "in", "1", [{"key": "r", "ts": T0}] * 2)
    assert until(rocksdb, tmp_path, lambda f: len(f) > 1, 100.0, 1500) == [("r", 1, "WAIT"), ("r", 2, "WAIT")]
    time.sleep(2)
    put(tmp_path / "in", "2", [{"key": "r", "ts": T0}])
    assert until(rocksdb, tmp_path, bool, 100.0, 1500) == [("r", 1, "WAIT")]
