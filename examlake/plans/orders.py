"""Queries for predicates, projections, orders, sets, dates and small functions (P, O, U, N, D, W16, W17)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from examlake.functions import text as T
from examlake.operators import gates, intervals, reconcile, select, state, store
from examlake.plans.registry import query
from examlake.sources import layout, scratch, tables
from examlake.sources.tables import load


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND coalesce(o_orderpriority, '') <> ''")
def predicate_filters(spark, d):
    rows = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")
    return select.matching(rows, {"o_orderstatus": "F", "o_custkey": None}, {"o_orderpriority": ["1-URGENT", "2-HIGH"]}, ("o_orderpriority",)).select("o_orderkey", "o_orderpriority")


@query("SELECT * FROM orders WHERE o_orderkey = 42")
def point_lookup(spark, d):
    return tables.lookup(spark, d, "orders", "o_orderkey", 42)


@query("SELECT o_custkey, count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total, min(o_orderkey) AS first FROM orders WHERE o_custkey IN (42, 43, -7) GROUP BY o_custkey")
def bloom_lookup(spark, d):
    path = f"{scratch.shared_dir(spark)}/clustered-orders-{uuid.uuid4().hex}"
    layout.write_clustered(load(spark, d, "orders"), path, ["o_orderdate"], ["o_custkey"])
    found = spark.read.parquet(path).where(F.col("o_custkey").isin(42, 43, -7))
    return found.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"), F.min("o_orderkey").alias("first"))


@query(r"""WITH k AS (SELECT p_partkey, p_name, p_brand, 'S' || lpad((p_size % 24)::VARCHAR, 2, '0') AS s, 'S' || lpad((p_size % 24)::VARCHAR, 2, '0') || '-M' || (p_partkey % 3) AS m FROM part)
           SELECT p_partkey, starts_with(p_brand, 'Brand#1') AS prefixed, regexp_full_match(s, 'S\d{2}') AS subject_id, NOT (s IN ('S03', 'S07') OR m IN ('S05-M1')) AS kept, substr(p_name, 1, 5) AS short FROM k""")
def key_predicates(spark, d):
    k = F.format_string("S%02d-M%d-%d", F.col("p_size") % 24, F.col("p_partkey") % 3, "p_partkey")
    rows = load(spark, d, "part").select("p_partkey", "p_name", "p_brand", k.alias("k"))
    return rows.select("p_partkey", select.with_prefix(F.col("p_brand"), "Brand#1").alias("prefixed"), select.subject_ids(T.key_subject(F.col("k"))).alias("subject_id"), select.outside_subjects(F.col("k"), ("S03", "S07"), ("S05-M1",)).alias("kept"), select.truncated(F.col("p_name"), 5).alias("short"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 1 THEN c_name ELSE '' END AS chosen, CASE WHEN c_nationkey <> 0 THEN c_nationkey ELSE 99 END::INTEGER AS number,
          CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'none' END AS filled FROM customer""")
def first_non_empty(spark, d):
    k = F.col("c_custkey")
    a, b = F.when(k % 3 == 0, F.col("c_mktsegment")).otherwise(""), F.when(k % 3 == 1, F.col("c_name"))
    rows = load(spark, d, "customer").select("c_custkey", select.first_filled(a, b).alias("chosen"), select.first_nonzero(F.col("c_nationkey"), F.lit(99)).alias("number"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("filled"))
    return select.with_defaults(rows, {"filled": "none"})


@query("""SELECT n_nationkey, '{' || CASE WHEN n_nationkey % 2 = 0 THEN '"name":"' || n_name || '",' ELSE '' END || '"region":' || n_regionkey || '}' AS safe,
          n_nationkey::VARCHAR AS question_id, n_name AS subject_name, '' AS image_path FROM nation""")
def safe_projection(spark, d):
    rows = load(spark, d, "nation")
    named = rows.withColumn("safe", select.safe_json({"region": F.col("n_regionkey"), "name": F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name"))}))
    fields = {"question_id": F.col("n_nationkey"), "subject_name": F.col("n_name"), "image_path": F.lit(None)}
    return named.select("n_nationkey", "safe").join(select.canonical(rows, fields).withColumn("n_nationkey", F.col("question_id").cast("int")), "n_nationkey")


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50")
def fifo_limit(spark, d):
    return select.oldest(load(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate"], "o_orderkey", 50)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'no date' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS created FROM orders
          ORDER BY CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END NULLS FIRST, o_orderkey LIMIT 700""")
def time_text_order(spark, d):
    created = F.when(F.col("o_orderkey") % 5 == 0, "no date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return select.by_time(load(spark, d, "orders").select("o_orderkey", created.alias("created")), "created", "o_orderkey", 700)


@query("""SELECT n_name, CASE n_regionkey WHEN 3 THEN 0 WHEN 1 THEN 1 WHEN 0 THEN 2 WHEN 2 THEN 3 ELSE 4 END::INTEGER AS place, n_nationkey::INTEGER AS suffix FROM nation""")
def declared_order(spark, d):
    place = select.declared_order(F.col("n_regionkey"), [3, 1], [0, 1, 2, 3])
    return load(spark, d, "nation").select("n_name", place.alias("place"), select.suffix_number(F.format_string("S%02d", "n_nationkey")).alias("suffix"))


@query("SELECT event_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-05 00:00:00'")
def delay_queue(spark, d):
    return select.due(load(spark, d, "events").select("event_id", "ts"), "ts", "event_id", F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))


@query("""WITH r AS (SELECT s_nationkey, s_name, s_acctbal, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_name) AS k FROM supplier WHERE s_acctbal > 0)
          SELECT s_nationkey, s_name, s_acctbal FROM r WHERE k = 1""")
def best_available(spark, d):
    rows = load(spark, d, "supplier").select("s_nationkey", "s_name", "s_acctbal")
    return select.best_available(rows, ["s_nationkey"], "s_name", "s_acctbal", F.col("s_acctbal") > 0)


@query("SELECT doc_id, source FROM documents ORDER BY ((doc_id + 7) * 2654435761) % 4294967296, doc_id LIMIT 20")
def seeded_sample(spark, d):
    return select.seeded_sample(load(spark, d, "documents").select("doc_id", "source"), "doc_id", 20, 7)


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100 OFFSET 300")
def offset_page(spark, d):
    return select.page(load(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 100, 3)


@query("""WITH r AS (SELECT conv_id, turn, substr(text, 1, 50) AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations)
          SELECT conv_id, array_to_string(list(t ORDER BY k), '|') AS texts FROM r WHERE k <= 3 GROUP BY 1""")
def dedup_context(spark, d):
    out = select.known_texts(load(spark, d, "conversations").select("conv_id", "turn", "text"), ["conv_id"], "turn", "text", 3)
    return out.select("conv_id", F.array_join("texts", "|").alias("texts"))


@query("""SELECT p_partkey, array_to_string([x FOR x IN [p_type, p_brand, 'ECONOMY'] IF true], ',') AS all_values,
          CASE WHEN p_type = 'ECONOMY' THEN p_type || ',' || p_brand ELSE p_type || ',' || p_brand || ',ECONOMY' END AS once,
          [least(p_size, 30), 40]::VARCHAR AS steps, p_size > 25 AS any_large FROM part""")
def array_functions(spark, d):
    rows = load(spark, d, "part")
    values = F.array("p_type", "p_brand", F.lit("ECONOMY"))
    numbers = F.array("p_size", F.lit(3))
    raw = F.concat_ws(",", F.least("p_size", F.lit(30)).cast("string"), F.lit("x"), F.lit("90"), F.lit("-5"), F.lit(" 41"))
    steps = T.steps(raw, -1, 40)
    return rows.select("p_partkey", F.array_join(F.slice(values, 1, 3), ",").alias("all_values"), F.array_join(select.distinct_in_order(values), ",").alias("once"), F.concat(F.lit("["), F.array_join(steps.cast("array<string>"), ", "), F.lit("]")).alias("steps"), F.exists(numbers, lambda x: x > 25).alias("any_large"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'over' ELSE n_name END AS name, n_regionkey::VARCHAR AS region, CASE WHEN n_nationkey % 2 = 0 THEN 'x' END AS extra FROM nation""")
def map_overlay(spark, d):
    base = F.create_map(F.lit("name"), "n_name", F.lit("region"), F.col("n_regionkey").cast("string"))
    over = F.when(F.col("n_nationkey") % 2 == 0, F.create_map(F.lit("name"), F.lit("over"), F.lit("extra"), F.lit("x")))
    both = load(spark, d, "nation").select("n_nationkey", select.overlay(base, over).alias("m"))
    return both.select("n_nationkey", *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("name", "region", "extra")])


@query("""SELECT 'unknown_nation' AS error, c_custkey AS key, NULL::VARCHAR AS detail FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 4)
          UNION ALL SELECT 'low_balance', s_suppkey, s_name FROM supplier WHERE s_acctbal < 0""")
def combined_errors(spark, d):
    known = load(spark, d, "nation").where("n_regionkey <> 4")
    lost = state.orphans(load(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_nationkey"), known, "c_nationkey", "n_nationkey").select("key")
    low = load(spark, d, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("detail"))
    return select.errors_of(("unknown_nation", lost), ("low_balance", low)).select("error", "key", "detail")


@query("SELECT user_id FROM events WHERE event_type = 'error' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'signup') GROUP BY 1")
def key_intersection(spark, d):
    e = load(spark, d, "events")
    return reconcile.in_both(e.where("event_type = 'error'"), e.where("event_type = 'signup'"), "user_id")


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, (date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) // 60 // 60)::VARCHAR || 'h' || (date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) // 60 % 60)::VARCHAR || 'm' AS elapsed,
          substr(sha256(event_id::VARCHAR || '|' || event_type), 1, 16) AS short_id, least(30, 5 * (event_id % 9 + 1))::INTEGER AS linear, least(60, 5 * (2 ** (event_id % 9)))::INTEGER AS doubling,
          [60, 120, 240][least(event_id % 9, 2) + 1]::INTEGER AS listed, least(greatest(value, 10.0), 90.0) AS held FROM events""")
def dates_and_ids(spark, d):
    n, ts = (F.col("event_id") % 9).cast("int"), F.col("ts").cast("timestamp")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return load(spark, d, "events").select("event_id", select.iso_seconds(ts).alias("iso"), select.elapsed(start, ts).alias("elapsed"), select.short_id(F.col("event_id"), F.col("event_type")).alias("short_id"), select.backoff(n).alias("linear"), select.backoff(n, "doubling").alias("doubling"), select.backoff(n, "listed").alias("listed"), select.held(F.col("value"), 10.0, 90.0).alias("held"))


@query("""SELECT user_id, event_type, max(value) AS value FROM events WHERE user_id % 2 = 0 AND event_type IN ('error', 'view') GROUP BY ALL""")
def status_union(spark, d):
    rows = select.matching(load(spark, d, "events"), {}, {"event_type": sorted({"error"} | {"view", "error"})}).where("user_id % 2 = 0")
    return rows.groupBy("user_id", "event_type").agg(F.max("value").alias("value"))


@query("""WITH a AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer), b AS (SELECT s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS k FROM supplier)
          SELECT c_nationkey AS nation, c_custkey, s_suppkey FROM a JOIN b ON c_nationkey = s_nationkey AND a.k = b.k""")
def positional_zip(spark, d):
    a = load(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey")
    b = load(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey")
    return store.zipped(a, b, ["nation"], ["c_custkey"], ["s_suppkey"])


@query("""SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size % 5 = 0 THEN 'name' END, CASE WHEN p_size % 3 = 0 THEN 'brand' END], lambda x: x IS NOT NULL), ',') AS missing FROM part""")
def required_fields(spark, d):
    rows = load(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 5 != 0, F.col("p_name")).alias("name"), F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_brand")).alias("brand"))
    return rows.select("p_partkey", F.array_join(gates.missing({k: ~select.is_filled(F.col(k)) for k in ("name", "brand")}), ",").alias("missing"))


#: Leases: from shipping on, for as many days as the order's number says, none at times.
LEASES = "SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate::DATE AS s, l_shipdate::DATE + (l_orderkey % 20)::INTEGER AS e FROM lineitem"


def _leases(spark, d):
    start = F.col("l_shipdate").cast("date")
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", start.alias("s"), F.date_add(start, (F.col("l_orderkey") % 20).cast("int")).alias("e"))


@query(f"""WITH i AS ({LEASES}) SELECT a.l_suppkey, a.s::VARCHAR AS s, a.e::VARCHAR AS e, count(b.l_orderkey) AS calls FROM (SELECT DISTINCT l_suppkey, s, e FROM i) a LEFT JOIN i b ON a.l_suppkey = b.l_suppkey AND b.s >= a.s AND b.s < a.e GROUP BY ALL""")
def lease_calls(spark, d):
    """Leases of a supplier, and the calls, lines shipped, that fall within them."""
    leases = _leases(spark, d)
    spans = leases.select("l_suppkey", "s", "e").distinct()
    return intervals.counted_within(spans, leases.select("l_suppkey", F.col("s").alias("at")), "s", "e", "at", 16, ["l_suppkey"], ["l_suppkey", "s", "e"], "calls").withColumns({"s": F.col("s").cast("string"), "e": F.col("e").cast("string")})


@query(f"""WITH i AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS id FROM ({LEASES}) WHERE s < e),
               m AS (SELECT *, max(e) OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
               p AS (SELECT *, sum((reach IS NULL OR s > reach)::INTEGER) OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY s, e, id ROWS UNBOUNDED PRECEDING) AS spell FROM m),
               w AS (SELECT l_suppkey, l_linenumber, spell, min(s) AS s, max(e) AS e, count(*) AS n FROM p GROUP BY ALL),
               g AS (SELECT *, date_diff('day', lag(e) OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY s), s) AS gap FROM w),
               t AS (SELECT a.l_suppkey, a.l_linenumber, a.id, count(*) AS k FROM i a JOIN i b ON a.l_suppkey = b.l_suppkey AND a.l_linenumber = b.l_linenumber AND b.s <= a.s AND a.s < b.e GROUP BY ALL),
               u AS (SELECT l_suppkey, l_linenumber, max(k) AS most FROM t GROUP BY ALL)
          SELECT l_suppkey, l_linenumber, sum(n)::BIGINT AS leases, sum(date_diff('day', s, e))::BIGINT AS busy, count(*) AS spells, coalesce(max(gap), 0)::BIGINT AS longest_gap, max(most)::BIGINT AS most
          FROM g JOIN u USING (l_suppkey, l_linenumber) GROUP BY ALL""")
def lease_coverage(spark, d):
    """Spells, gaps and overlaps of the leases of each supplier and line number."""
    return intervals.coverage(_leases(spark, d), ["l_suppkey", "l_linenumber"], "s", "e")
