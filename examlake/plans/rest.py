"""Queries for writes that keep what is there, overlays, completed items, versions and small checks (K2, S3, J5, J9, J17,
U2, P5, P6, P18, N3, T27, G11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from examlake.functions import text as T
from examlake.operators import gates, pixels, reconcile, select, state, store
from examlake.plans.registry import query
from examlake.sources import tables
from examlake.sources.scratch import shared_dir
from examlake.sources.tables import load


@query("""SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0) GROUP BY 1""")
def insert_ignore(spark, d):
    known = load(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return state.insert_ignore(load(spark, d, "orders").select("o_custkey", "o_orderkey"), known, "o_custkey")


@query("""WITH s AS (SELECT user_id, event_id, CASE WHEN event_type <> 'error' THEN value END AS value, CASE WHEN event_type IN ('click', 'view') THEN event_type END AS kind FROM events)
          SELECT user_id, arg_max(value, event_id) FILTER (value IS NOT NULL) AS value, arg_max(kind, event_id) FILTER (kind IS NOT NULL) AS kind FROM s GROUP BY 1""")
def priority_overlay(spark, d):
    t = F.col("event_type")
    sources = load(spark, d, "events").select("user_id", "event_id", F.when(t != "error", F.col("value")).alias("value"), F.when(t.isin("click", "view"), t).alias("kind"))
    return reconcile.overlaid(sources, "user_id", "event_id", ["value", "kind"])


@query("""WITH s AS (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS source, o_orderkey FROM orders)
          SELECT o_custkey, source, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY source, o_orderkey) AS r FROM s) WHERE r = 1""")
def first_source(spark, d):
    source = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "P", 2).otherwise(3)
    return reconcile.first_of(load(spark, d, "orders").select("o_custkey", source.alias("source"), "o_orderkey"), "o_custkey", "source")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE NOT (o_orderstatus IN ('F', 'O') AND o_orderkey % 6 = 5)""")
def reruns(spark, d):
    """Items that a rerun must take again: those without a completed result."""
    items = load(spark, d, "orders")
    decision = F.when(F.col("o_orderstatus") == "F", "PASS").when(F.col("o_orderstatus") == "O", "FAIL").otherwise("TECH_FAIL")
    done = store.completed(items.select("o_orderkey", decision.alias("decision"), (F.col("o_orderkey") % 6).alias("valid_count")))
    return reconcile.pending(items.select("o_orderkey", "o_custkey"), done.select("o_orderkey"), "o_orderkey")


@query("SELECT c_custkey, c_acctbal, 0 AS version FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, c_acctbal + 1, 1 FROM customer WHERE c_custkey % 2 = 1")
def pinned_versions(spark, d):
    """Two versions of a table in folders of their own; what is read by the first path is what was first written."""
    import uuid

    root = f"{shared_dir(spark)}/versions-{uuid.uuid4().hex}"
    rows = load(spark, d, "customer").select("c_custkey", "c_acctbal")
    for n in (0, 1):
        rows.withColumn("c_acctbal", F.col("c_acctbal") + n).withColumn("version", F.lit(n)).write.parquet(f"{root}/{n}")
    old, new = (tables.pinned(spark, f"{root}/{n}", "c_custkey long, c_acctbal double, version int") for n in (0, 1))
    return old.where("c_custkey % 2 = 0").union(new.where("c_custkey % 2 = 1"))


@query(r"""WITH r AS (SELECT *, p_size * 64 AS bytes, (p_partkey % 260)::DOUBLE AS mean, 'correct=' || (p_partkey % 7) || ' wrong=' || (p_partkey % 6) || CASE WHEN p_partkey % 4 <> 3 THEN ' answers=A, B' ELSE '' END AS detail FROM part)
           SELECT p_partkey, bytes >= 1024 AS large, bytes >= 1024 AND mean BETWEEN 3 AND 254 AS sane, CASE WHEN p_partkey % 3 <> 0 THEN p_brand WHEN p_partkey % 2 = 0 THEN p_type END AS first,
                  ['single-step reading/calculation; 3-5 main visual elements', 'two-step reasoning; 4-6 main visual elements', 'multi-step reasoning with one distractor relation; 5-7 main visual elements', 'advanced synthesis; 6-8 main visual elements, but still visually uncluttered'][least(greatest(p_size % 7 - 1, 1), 4)] AS complexity,
                  p_partkey % 5 NOT IN (0, 1) AS options, CASE WHEN p_partkey % 7 <= 5 THEN p_partkey % 7 END::INTEGER AS correct, (p_partkey % 6)::INTEGER AS wrong, CASE WHEN p_partkey % 4 <> 3 THEN 'A,B' END AS answers FROM r""")
def small_checks(spark, d):
    k = F.col("p_partkey")
    p = load(spark, d, "part").withColumns({"bytes": F.col("p_size") * 64, "mean": (k % 260).cast("double")})
    none = F.array().cast("array<string>")
    held = select.first_sized(F.when(k % 3 != 0, F.array("p_brand")).otherwise(none), F.when(k % 2 == 0, F.array("p_type")))
    options = {"A": F.lit("1"), "B": F.when(k % 5 == 0, " \t").when(k % 5 == 1, "1\n").otherwise("2"), "C": F.lit("3"), "D": F.lit("4")}
    detail = T.lenient_detail(F.concat(F.lit("correct="), (k % 7).cast("string"), F.lit(" wrong="), (k % 6).cast("string"), F.when(k % 4 != 3, " answers=A, B").otherwise("")))
    return p.select(
        "p_partkey", pixels.file_sane(F.col("bytes")).alias("large"), pixels.file_sane(F.col("bytes"), F.col("mean")).alias("sane"), held[0].alias("first"),
        gates.complexity(F.col("p_size") % 7).alias("complexity"), gates.completed_options(options).alias("options"),
        detail["correct"].alias("correct"), detail["wrong"].alias("wrong"), F.array_join(detail["answers"], ",").alias("answers"),
    )
