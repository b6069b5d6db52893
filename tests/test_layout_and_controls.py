"""Bloom filters that spare row groups, settings that change between micro-batches, sweeps over boxes."""

import json

import numpy as np
from pyspark.sql import functions as F

from examlake.operators import pixels as P
from examlake.sources.layout import write_clustered
from examlake.streaming.controls import Settings, run_controlled


def rows_read(df):
    """Rows that the scan handed on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_bloom_filters_spare_row_groups(spark, tmp_path):
    n = 40_000
    df = spark.range(n).select((F.col("id") * 7919 % n * 2).alias("key"), F.col("id").alias("day"), F.lit("x").alias("Key 2"))
    write_clustered(df, str(tmp_path / "with"), ["day"], ["key"], files=4, distinct=10_000)
    df.repartitionByRange(4, "day").write.option("parquet.enable.dictionary", "false").parquet(str(tmp_path / "without"))
    held, plain = (spark.read.parquet(str(tmp_path / x)) for x in ("with", "without"))
    assert held.columns == df.columns and held.count() == n
    absent, present = 2 * 777 + 1, 2 * 777  # odd keys lie within every file's range and are in none
    assert rows_read(held.where(F.col("key") == absent)) == 0
    assert rows_read(plain.where(F.col("key") == absent)) > 0
    assert held.where(F.col("key") == present).count() == 1
    assert 0 < rows_read(held.where(F.col("key") == present)) <= n // 4 + 1


def test_layout_of_nulls_and_nothing(spark, tmp_path):
    df = spark.createDataFrame([(None, None), (None, 3), (5, None), (5, 3)], "a long, b long")
    write_clustered(df, str(tmp_path / "nulls"), ["a"], ["b"], files=2)
    back = spark.read.parquet(str(tmp_path / "nulls"))
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    write_clustered(df.limit(0), str(tmp_path / "none"), ["a"], ["b"], files=2)
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "none")).count() == 0


def test_settings(spark, tmp_path):
    file = tmp_path / "control.json"
    s = Settings(str(file), {"least": 1, "open": True})
    assert s.current(spark) == {"least": 1, "open": True}  # no file
    file.write_text('{"least": 5, "note": "x"}')
    assert s.current(spark) == {"least": 5, "open": True, "note": "x"}
    for broken in ('{"least": 6', "[1]", "", "7"):
        file.write_text(broken)
        assert s.current(spark) == {"least": 5, "open": True, "note": "x"}
    file.write_text("{}")
    assert s.current(spark) == {"least": 1, "open": True}


def test_a_stream_reloads_its_settings(spark, tmp_path):
    source, target, file = tmp_path / "in", tmp_path / "out", tmp_path / "control.json"
    settings = Settings(str(file), {"least": 0})

    def arrive(k):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(str(source))

    def apply(batch, now):
        if batch.where("id >= 10").isEmpty():
            file.write_text(json.dumps({"least": 15}))  # an operator edits the file while the first batch runs
        return batch.where(F.col("id") >= now["least"]).withColumn("least", F.lit(now["least"]))

    def run():
        rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(source))
        run_controlled(rows, settings, apply, str(target), str(tmp_path / "check"))
        return {(r["id"], r["least"]) for r in spark.read.parquet(str(target)).collect()}

    arrive(0), arrive(1)
    first = {(i, 0) for i in range(10)} | {(i, 15) for i in range(15, 20)}
    assert run() == first
    file.write_text('{"least": ')
    arrive(2)
    assert run() == first | {(i, 15) for i in range(20, 30)}  # broken: the last good settings hold


def test_sweeps_equal_all_pairs():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 60, 200):
        at = rng.integers(0, 100, (n, 2))
        boxes = np.hstack([at, at + rng.integers(0, 25, (n, 2))]).astype(float)
        want = 0
        for i in range(n):
            for j in range(i):
                (a, b, c, d), (e, f, g, h) = boxes[i], boxes[j]
                tall, wide, less = min(c, g) - max(a, e), min(d, h) - max(b, f), min((c - a) * (d - b), (g - e) * (h - f))
                want += tall > 0 and wide > 0 and less > 0 and tall * wide > 0.3 * less
        assert P.overlapping(boxes) == want
        centres = at.astype(float)
        assert P.close(centres, 5.0) == sum(np.hypot(*(centres[i] - centres[j])) < 5 for i in range(n) for j in range(i))
