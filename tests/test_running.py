"""Numbers in large groups: equal to a plain count, and no task holds a group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from examlake.operators import dashboard, running, store, windows
from examlake.streaming import stages


def plain(rows, key, order):
    out, n = {}, {}
    for r in sorted(rows, key=order):
        n[key(r)] = n.get(key(r), 0) + 1
        out[r["i"]] = n[key(r)]
    return out, n


def test_groups_of_any_size(spark):
    rows = [{"i": i, "g": None if i % 50 == 0 else "all" if i % 7 else f"g{i % 40}", "t": (i * 7919) % 1000, "_n": "clash"} for i in range(6000)]
    df = spark.createDataFrame([(r["i"], r["g"], r["t"], r["_n"]) for r in rows], "i int, g string, t int, n2 string").repartition(5)
    got = running.numbered(df, ["g"], ["t", "i"], "n", "size").collect()
    want, sizes = plain(rows, lambda r: r["g"], lambda r: (r["t"], r["i"]))
    assert {r["i"]: r["n"] for r in got} == want and all(r["size"] == sizes[r["g"]] for r in got) and len(got) == 6000
    assert running.numbered(df.limit(0), ["g"], ["t"], "n").count() == 0


def test_one_group_is_dealt_over_tasks(spark):
    df = spark.range(20_000).select(F.lit("one").alias("g"), ((F.col("id") * 7919) % 20_000).alias("t"), "id")
    held = running.numbered(df, ["g"], ["t"], "n")
    source = next(p for p in held.inputFiles())
    parts = spark.read.parquet(source.rsplit("/", 1)[0])
    most = parts.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert most < 8000
    w = Window.partitionBy("g").orderBy("t")
    assert held.withColumn("m", F.row_number().over(w)).where("n <> m").count() == 0


def test_repeated_rows(spark):
    df = spark.createDataFrame([("a", 1)] * 500 + [("b", 1)] * 3, "g string, t int")
    got = running.numbered(df, ["g"], ["t"], "n").collect()
    assert sorted(r["n"] for r in got if r["g"] == "a") == list(range(1, 501)) and sorted(r["n"] for r in got if r["g"] == "b") == [1, 2, 3]


def test_chunks_ids_and_admission(spark):
    df = spark.range(1030).select("id", (F.col("id") % 3).alias("g"), (F.col("id") * 31 % 1030).alias("t"))
    for size in (1, 10, 344):
        a, b = (windows.complete_chunks(df, ["g"], ["t"], size, split=s).collect() for s in (True, False))
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    rows = df.select("id", F.lit("S01").alias("s"), F.concat(F.lit("S01-M1-"), "g").alias("k"), "t")
    base = spark.createDataFrame([("S01-M1-0", 7)], "k string, base int")
    a, b = (sorted(map(tuple, store.with_ids(rows, "s", "k", ["t"], base, split=s).collect())) for s in (True, False))
    assert a == b
    got = stages.admitted(df, ["g"], ["t"], F.lit(20)).where("admitted")
    assert [r["count"] for r in got.groupBy("g").count().collect()] == [20, 20, 20]


def test_taxonomy_flat_and_nested(spark):
    flat = spark.createDataFrame([("S1", "m1", 1), ("S1", "m1", 2), ("S1", "m2", None), ("S2", None, None)], "s string, m string, p int")
    nested = spark.createDataFrame([("S1", [("m1", ["1", "2"]), ("m2", None)]), ("S2", None)], "subject_id string, modules array<struct<module_id: string, knowledge_points: array<string>>>")
    a, b = dashboard.taxonomy_counts(flat, "s", "m", "p", 2), dashboard.taxonomy_sizes(nested, 2)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) == [("S1", 2, 2, True), ("S2", 0, 0, True)]
