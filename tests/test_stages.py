"""Stages over an event store, retries, monitors, milestones, and incremental sources."""

import json

import numpy as np
from pyspark.sql import functions as F

from examlake.operators import store
from examlake.sources import tables
from examlake.streaming import stages


def test_line_with_regeneration(spark, tmp_path):
    folder = str(tmp_path / "store")
    rows = [(f"r{i}", "GENERATED", 0, None) for i in range(6)]
    spark.createDataFrame(rows, stages.STORE).coalesce(1).write.parquet(f"{folder}/start-000000000")
    bad = F.col("record_id").isin("r4", "r5") & ((F.col("record_id") == "r5") | (F.col("seq") < 2))
    review = lambda b: stages.with_regeneration(b, bad, "ACCEPTED")
    again = lambda b: b.select("record_id", F.lit("GENERATED").alias("status"), (F.col("seq") + 1).alias("seq"), "detail")
    draw = lambda b: b.select("record_id", F.lit("FINAL_PASS").alias("status"), (F.col("seq") + 1).alias("seq"), "detail")
    line = [("review", "GENERATED", review), ("regen", "REGENERATE", again), ("image", "ACCEPTED", draw)]
    assert stages.drained(spark, folder, line) >= 3
    events = spark.read.schema(stages.STORE).option("recursiveFileLookup", "true").parquet(folder)
    last = {r["record_id"]: r["status"] for r in events.groupBy("record_id").agg(F.max_by("status", "seq").alias("status")).collect()}
    assert last == {**{f"r{i}": "FINAL_PASS" for i in range(5)}, "r5": "DISCARDED"}
    assert stages.drained(spark, folder, line) == 1  # nothing is left to do


def test_retries_and_monitor(spark, tmp_path):
    spark.createDataFrame([("a",), ("b",), ("b",), ("b",), ("b",)], "record_id string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("record_id string").parquet(str(tmp_path / "in"))
    q = stages.retries(stream).writeStream.outputMode("append").format("memory").queryName("retries").option("checkpointLocation", str(tmp_path / "c1")).start()
    while not q.lastProgress and q.isActive:  # timers keep the query going, so it is stopped by hand
        q.awaitTermination(1)
    q.stop()
    assert {(r["record_id"], r["attempt"], r["status"]) for r in spark.table("retries").collect()} == {("a", 1, "WAIT"), ("b", 4, "HOLD")}
    rows = [("l", f"2024-01-01 00:0{i}:00", 5 if i > 1 else i, 3, 0.9) for i in range(9)]
    df = spark.createDataFrame(rows, "line string, ts string, total_pass long, total_reviewed long, review_fill double").withColumn("ts", F.to_timestamp("ts"))
    df.coalesce(1).write.parquet(str(tmp_path / "snap"))
    q = stages.stall_monitor(spark.readStream.schema(df.schema).parquet(str(tmp_path / "snap"))).writeStream.outputMode("append").format("memory").queryName("stalls").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["stalled"] for r in spark.table("stalls").orderBy("ts").collect()] == [False] * 6 + [True] * 3


def test_milestones(spark, tmp_path):
    for part, n in enumerate((130, 40, 150)):
        spark.range(n).coalesce(1).write.mode("append").parquet(str(tmp_path / "passes"))
        stages.milestones(spark, spark.readStream.schema("id long").parquet(str(tmp_path / "passes")), str(tmp_path / "out"), str(tmp_path / "c"), 100, 250)
        found = spark.read.option("recursiveFileLookup", "true").schema("milestone long, action string").parquet(str(tmp_path / "out" / "milestones")).collect()
        want = {100} if part < 2 else {100, 200, 300}
        assert {r["milestone"] for r in found if r["action"] == "sample"} == want and len(found) == len(want) + (part == 2)


def test_fan_out(spark):
    out = stages.fanned_out(spark.range(20), lambda t: t.assign(twice=t["id"] * 2), "id long, twice long", 3)
    assert sorted((r["id"], r["twice"]) for r in out.collect()) == [(i, 2 * i) for i in range(20)]


def test_sources(spark, tmp_path):
    (tmp_path / "dim.csv").write_text("kp_id,target_quota,kp_name\nk1,3.7,one\nk2,x,\n")
    got = tables.dimension_csv(spark, str(tmp_path / "dim.csv"), {"quota": "target_quota", "other": "none"}, {"kp": "kp_id", "name": "kp_name"}).collect()
    assert sorted(map(tuple, got)) == [("k1", "one", 3, 0), ("k2", "", 0, 0)]
    (tmp_path / "s1.json").write_text(json.dumps([{"question_id": "a", "options": {"A": "1"}}, {"question_id": "b", "options": {}}]))
    assert [r["question_id"] for r in store.json_array(spark, str(tmp_path / "s1.json"), "question_id string, options map<string,string>").collect()] == ["a", "b"]
    (tmp_path / "control.json").write_text('{"pause": true}')
    assert tuple(tables.controls(spark, str(tmp_path / "control.json"), {"pause": False, "slots": 12}).first()) == (True, 12)
    assert [r["length"] for r in tables.listing(spark, str(tmp_path), ".csv").collect()] == [44]
    taxonomy = spark.createDataFrame([("S1", "n", [("m1", [("k1",), ("k2",)])], [("k3",)]), ("S2", "n", None, [])], "subject_id string, subject_name string, modules array<struct<module_id:string,knowledge_points:array<struct<knowledge_point_id:string>>>>, knowledge_points array<struct<knowledge_point_id:string>>")
    assert sorted((r["module_id"] or "", r["knowledge_point_id"]) for r in tables.knowledge_points(taxonomy).collect()) == [("", "k3"), ("m1", "k1"), ("m1", "k2")]
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "a.log").write_text("one\ntwo\n")
    for _ in range(2):  # the second run finds nothing new
        q = tables.tailed_lines(spark, str(folder)).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "lines"))
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "lines")).count() == 2


def test_store_sinks(spark, tmp_path):
    items = spark.createDataFrame([("S1", "k2", "b"), ("S1", "k1", "a"), ("S2", "k1", "c")], "subject_id string, kp_id string, question_id string")
    store.packages(items, "subject_id", ["kp_id", "question_id"], str(tmp_path / "pkg"))
    assert [r["question_id"] for r in spark.read.json(str(tmp_path / "pkg" / "subject_id=S1")).collect()] == ["a", "b"]
    counts = spark.createDataFrame([("S1", "one", 2, 2), ("S2", "two", 1, 1)], "subject_id string, subject_name string, questions long, files long")
    errors = spark.createDataFrame([], "subject_id string, error string, n long")
    doc = json.loads(store.index_document(counts, errors, "v1", ["question_id"]).first()["document"])
    assert doc["total_questions"] == 3 and doc["validation_status"] == "PASS" and [s["subject_id"] for s in doc["subjects"]] == ["S1", "S2"]
    bad = spark.createDataFrame([("S1", "x", 2)], "subject_id string, error string, n long")
    assert json.loads(store.index_document(counts, bad, "v1", []).first()["document"])["validation_errors"] == [{"error": "x", "n": 2}]
    store.append_lines(items, str(tmp_path / "lines"))
    store.append_lines(items, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 6
    store.snapshot(items, str(tmp_path / "state"), 1)
    store.snapshot(items.limit(1), str(tmp_path / "state"), 2)
    (tmp_path / "state" / "version=000000000003").mkdir()  # a write that was cut short
    assert store.last_snapshot(spark, str(tmp_path / "state")).count() == 1
    assert store.markdown(items.orderBy("question_id"), ["question_id", "kp_id"], 2).splitlines()[2:] == ["| a | k1 |", "| b | k2 |", "(more than 2 rows)"]
    store.cloned(spark, {"items": items, "other": counts}, items.where("question_id = 'a'"), "question_id", str(tmp_path / "clone"))
    assert spark.read.parquet(str(tmp_path / "clone" / "items")).count() == 1 and spark.read.parquet(str(tmp_path / "clone" / "other")).count() == 2


def test_image_source(spark, tmp_path):
    import struct
    import zlib

    def png(a):
        raw = b"".join(b"\0" + r.tobytes() for r in a)
        part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
        return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw, 0)) + part(b"IEND", b"")

    from examlake.operators import pixels

    a = np.random.default_rng(0).integers(0, 255, (40, 30, 3), np.uint8)
    (tmp_path / "a.png").write_bytes(png(a))
    (tmp_path / "b.png").write_bytes(b"no image" * 300)
    rows = pixels.images(spark, str(tmp_path)).orderBy("path").collect()
    assert [(r["height"], r["width"]) for r in rows] == [(40, 30), (-1, -1)] and rows[0]["size"] == len(png(a))
    assert (pixels.array(rows[0]["pixels"], 40, 30, 3)[:, :, ::-1] == a).all()
