"""Work of one key or one cell is dealt over several tasks."""

from pyspark.sql import functions as F

from examlake.llm import topk


def test_block_pairs_of_one_dimension(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        buckets = spark.range(5).select(F.lit(8).alias("dim"), F.col("id").alias("block"), F.col("id").cast("double").alias("longest"))
        ready = spark.range(40).select(F.lit(8).alias("dim"), F.col("id").alias("q_block"), F.lit(2.0).alias("need"))
        pairs = topk.admitted(buckets, ready, 4)
        assert pairs.select(F.spark_partition_id()).distinct().count() > 1
        assert sorted(map(tuple, pairs.collect())) == [(b, q) for b in (2, 3, 4) for q in range(40)]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
