"""Queries for the record store, exports, dashboards and the production line (K, A, G10, J5-J7, J16, W1, W2, W10, ST)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from examlake.functions import text as T
from examlake.functions import variants
from examlake.operators import dashboard, gates, progress, rollouts, store, windows
from examlake.operators.select import load_weight
from examlake.plans.registry import query
from examlake.sources import recorded
from examlake.sources.scratch import written
from examlake.sources.tables import load
from examlake.streaming import stages

#: Statuses that event types stand for.
STATUSES = "CASE event_type WHEN 'purchase' THEN 'FINAL_PASS' WHEN 'view' THEN 'ACCEPTED' WHEN 'click' THEN 'GENERATED' WHEN 'error' THEN 'RENDER_FAIL' ELSE 'HOLD' END"


def _records(spark, d):
    t = F.col("event_type")
    status = F.when(t == "purchase", "FINAL_PASS").when(t == "view", "ACCEPTED").when(t == "click", "GENERATED").when(t == "error", "RENDER_FAIL").otherwise("HOLD")
    return load(spark, d, "events").select("event_id", "user_id", "ts", "value", "props", status.alias("status"))


@query("""WITH n AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) + CASE WHEN o_custkey % 2 = 0 THEN o_custkey ELSE 0 END AS n FROM orders)
          SELECT o_orderkey, 'S01-' || o_custkey || '-Q' || CASE WHEN n < 10000 THEN lpad(n::VARCHAR, 4, '0') ELSE n::VARCHAR END AS record_id FROM n""")
def record_ids(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderdate", F.lit("S01").alias("subject"), F.concat(F.lit("K-"), F.col("o_custkey").cast("string")).alias("kp"))
    base = load(spark, d, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("K-"), F.col("c_custkey").cast("string")).alias("kp"), F.col("c_custkey").cast("int").alias("base"))
    return store.with_ids(orders, "subject", "kp", ["o_orderdate", "o_orderkey"], base).select("o_orderkey", "record_id")


@query("""SELECT coalesce(c_custkey, o_custkey) AS k, coalesce(c_nationkey, 0) AS target, coalesce(n, 0) AS n, coalesce(passed, 0) AS passed FROM (SELECT * FROM customer WHERE c_custkey % 2 = 0)
          FULL JOIN (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS passed FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def stats_upsert(spark, d):
    stats = load(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("target"))
    counts = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("passed"))
    return store.replaced_stats(stats, counts, "k", "target", ["n", "passed"])


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'IN_PROGRESS' ELSE o_orderstatus END AS status FROM orders")
def conditional_update(spark, d):
    return load(spark, d, "orders").select("o_orderkey", store.claimed(F.col("o_orderstatus"), "P").alias("status"))


ALLOWED = "(SELECT * FROM (VALUES ('ACCEPTED', 'FINAL_PASS'), ('ACCEPTED', 'RENDER_FAIL'), ('GENERATED', 'ACCEPTED'), ('GENERATED', 'HOLD'), (NULL, 'GENERATED')) t(old_status, new_status))"


@query(f"""WITH u AS (SELECT event_id, user_id, lag({STATUSES}) OVER (PARTITION BY user_id ORDER BY event_id) AS old_status, {STATUSES} AS new_status FROM events)
           SELECT event_id, CASE WHEN user_id % 10 = 3 THEN 'unknown record' WHEN EXISTS (SELECT 1 FROM {ALLOWED} a WHERE a.new_status = u.new_status AND a.old_status IS NOT DISTINCT FROM u.old_status) THEN 'accepted' ELSE 'transition' END AS outcome FROM u""")
def audited_updates(spark, d):
    log = _records(spark, d).withColumn("old_status", F.lag("status").over(Window.partitionBy("user_id").orderBy("event_id"))).select("event_id", "user_id", "old_status", F.col("status").alias("new_status"))
    allowed = spark.createDataFrame([("ACCEPTED", "FINAL_PASS"), ("ACCEPTED", "RENDER_FAIL"), ("GENERATED", "ACCEPTED"), ("GENERATED", "HOLD"), (None, "GENERATED")], "old_status string, new_status string")
    good, bad = store.checked_updates(log, log.where("user_id % 10 <> 3"), "user_id", allowed)
    return good.select("event_id", F.lit("accepted").alias("outcome")).unionByName(bad.select("event_id", F.col("reason").alias("outcome")))


@query("""SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def fresh_rows(spark, d):
    labels = load(spark, d, "labels")
    return store.fresh(load(spark, d, "documents").select("doc_id"), labels.where("quality = 0"), labels.where("toxic = 1"), "doc_id")


@query("""WITH m AS (SELECT c_nationkey, c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS tested FROM customer), k AS (SELECT *, count(*) FILTER (NOT tested) OVER (PARTITION BY c_nationkey) AS n FROM m)
          SELECT c_nationkey, c_custkey FROM k WHERE n < 2 OR NOT tested""")
def untested_points(spark, d):
    tested = load(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return store.untested(load(spark, d, "customer").select("c_nationkey", "c_custkey"), tested, "c_nationkey", "c_custkey", 2).select("c_nationkey", "c_custkey")


@query("""SELECT o_orderkey, o_totalprice, 'samples/' || o_orderkey || '.png' AS path FROM orders WHERE o_orderkey % 50 = 0""")
def sampled_files(spark, d):
    orders = load(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("record_id"), "o_orderkey", "o_totalprice")
    files = load(spark, d, "orders").where("o_orderkey % 50 = 0").select(F.format_string("samples/%d.png", "o_orderkey").alias("path"))
    return store.of_files(orders, files, "path", "record_id").select("o_orderkey", "o_totalprice", "path")


@query("""WITH n AS (SELECT o_orderkey, o_orderpriority, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1) // 100 AS chunk FROM orders),
          f AS (SELECT *, count(*) OVER (PARTITION BY o_orderpriority, chunk) AS c, row_number() OVER (PARTITION BY o_orderpriority, chunk ORDER BY (o_orderkey * 2654435761) % 4294967296, o_orderkey) AS r FROM n)
          SELECT o_orderkey, o_orderpriority, chunk FROM f WHERE c = 100 AND r <= 3""")
def milestone_sample(spark, d):
    rows = load(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return store.milestone_sample(rows, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "o_orderkey").drop("o_orderdate")


@query("""WITH n AS (SELECT o_orderkey, o_custkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 10 AS chunk FROM orders WHERE o_orderkey % 7 <> 0),
          f AS (SELECT *, count(*) OVER (PARTITION BY o_custkey, chunk) AS c FROM n) SELECT o_orderkey, o_custkey, chunk FROM f WHERE c = 10""")
def remembered_export(spark, d):
    rows = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    return store.next_export(rows, rows.where("o_orderkey % 7 = 0"), ["o_custkey"], ["o_orderkey"], "o_orderkey")


@query("""WITH i AS (SELECT c_nationkey AS subject_id, c_name || '.png' AS image FROM customer), m AS (SELECT c_nationkey AS subject_id, c_name || '.png' AS image FROM customer WHERE c_custkey % 9 <> 0 UNION ALL SELECT s_nationkey, s_name FROM supplier),
          q AS (SELECT subject_id, count(*) AS questions FROM i GROUP BY 1), f AS (SELECT subject_id, count(*) AS files FROM m GROUP BY 1),
          c AS (SELECT n_nationkey AS subject_id, coalesce(questions, 0) AS questions, coalesce(files, 0) AS files FROM nation LEFT JOIN q ON n_nationkey = q.subject_id LEFT JOIN f ON n_nationkey = f.subject_id)
          SELECT subject_id::VARCHAR AS subject_id, 'question_image_count_mismatch' AS error, abs(questions - files) AS n FROM c WHERE questions <> files
          UNION ALL SELECT subject_id, 'missing_referenced_images', count(*) FROM i WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.subject_id = i.subject_id AND m.image = i.image) GROUP BY 1
          UNION ALL SELECT subject_id, 'extra_unreferenced_images', count(*) FROM m WHERE NOT EXISTS (SELECT 1 FROM i WHERE m.subject_id = i.subject_id AND m.image = i.image) GROUP BY 1
          UNION ALL SELECT NULL, 'total_question_count_mismatch', sum(questions)::BIGINT FROM c HAVING sum(questions) <> 1000 UNION ALL SELECT NULL, 'total_image_count_mismatch', sum(files)::BIGINT FROM c HAVING sum(files) <> 1000""")
def export_gate(spark, d):
    items = load(spark, d, "customer").select(F.col("c_nationkey").alias("subject_id"), F.concat("c_name", F.lit(".png")).alias("image"), "c_custkey")
    files = items.where("c_custkey % 9 <> 0").drop("c_custkey").unionByName(load(spark, d, "supplier").select(F.col("s_nationkey").alias("subject_id"), F.col("s_name").alias("image")))
    errors = store.export_errors(items.drop("c_custkey"), files, load(spark, d, "nation").select(F.col("n_nationkey").alias("subject_id")), 1000)
    return errors.withColumn("subject_id", F.col("subject_id").cast("string"))


@query("""SELECT c_custkey, c_custkey % 11 <> 0 AND c_nationkey < 20 AS exported, CASE WHEN c_custkey % 11 = 0 THEN 'invalid question_json' WHEN c_nationkey >= 20 THEN 'excluded_subject:' || c_nationkey
          ELSE array_to_string(list_filter([CASE WHEN c_custkey % 5 = 0 THEN 'missing_or_empty: name' END], lambda x: x IS NOT NULL), ',') END AS warnings FROM customer""")
def export_warnings(spark, d):
    rows = load(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("subject_id"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("name"))
    out = store.exported_items(rows, [str(i) for i in range(20)], {"name": F.col("name"), "subject": F.col("subject_id")}, F.col("c_custkey") % 11 != 0)
    return out.select("c_custkey", "exported", F.array_join("warnings", ",").alias("warnings"))


@query("""SELECT n_name, question_count, image_count, CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM
          (SELECT n_name, count(c_custkey) AS question_count, count(*) FILTER (c_acctbal >= 0) AS image_count, count(*) FILTER (c_acctbal < 0) AS bad FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY ROLLUP (n_name))""")
def export_totals(spark, d):
    rows = load(spark, d, "nation").join(load(spark, d, "customer"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return rows.rollup("n_name").agg(F.count("c_custkey").alias("question_count"), F.count_if(F.col("c_acctbal") >= 0).alias("image_count"), F.when(F.count_if(F.col("c_acctbal") < 0) == 0, "PASS").otherwise("FAIL").alias("status"))


@query("""SELECT o_custkey, part::INTEGER AS part, array_to_string(list(o_orderkey ORDER BY k), ',') AS keys FROM (SELECT o_custkey, o_orderkey, k, (k - 1) // 4 AS part FROM
          (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders)) GROUP BY 1, 2""")
def ordered_lists(spark, d):
    out = dashboard.lists(load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey", 4)
    return out.select("o_custkey", "part", F.array_join(F.col("values").cast("array<string>"), ",").alias("keys"))


@query("""SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) AS every FROM orders GROUP BY 1""")
def count_modes(spark, d):
    orders = load(spark, d, "orders")
    done = dashboard.progress_count(orders, ["o_custkey"], "o_orderstatus", ["F"]).withColumnRenamed("progress", "done")
    return done.join(dashboard.progress_count(orders, ["o_custkey"], "o_orderstatus", ["F"], "all").withColumnRenamed("progress", "every"), "o_custkey")


@query("""SELECT o_orderpriority, n, round(100.0 * n / sum(n) OVER (), 1) AS per_cent FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)""")
def most_common_share(spark, d):
    top = dashboard.most_common(load(spark, d, "orders"), "o_orderpriority")
    return top.withColumn("per_cent", dashboard.share(F.col("n"), F.sum("n").over(Window.partitionBy())))  # a row a value


@query(f"""SELECT count(*) AS total, count(*) FILTER (s = 'FINAL_PASS') AS final_pass, count(*) FILTER (s = 'RENDER_FAIL') AS render_fail, count(*) FILTER (s = 'HOLD') AS hold, 0::BIGINT AS pending, count(w) AS scored,
           count(*) FILTER (w >= 3) AS hard_enough, count(*) FILTER (NOT coalesce(w >= 3, false) AND w IS NOT NULL AND 5 - w >= 3) AS too_easy, count(*) FILTER (s = 'HOLD') AS technical, coalesce(sum(w), 0)::BIGINT AS wrong_answers,
           coalesce(sum(5 - w), 0)::BIGINT AS right_answers, 0::BIGINT AS unknown FROM (SELECT {STATUSES} AS s, CASE WHEN event_id % 3 <> 0 THEN event_id % 6 END AS w FROM events)""")
def dashboard_summary(spark, d):
    wrong = F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 6)
    rows = _records(spark, d).withColumns({"wrong": wrong, "correct": 5 - wrong, "note": F.when(F.col("status") == "HOLD", "Qwen_Technical failure")})
    return dashboard.summary(rows, "status", "wrong", "correct", "note")


@query(r"""WITH j AS (SELECT event_id, '{"p": ' || props || ', "who": {"id": ' || user_id || ', "tags": ["' || event_type || '", [' || event_id || ', null, true, "say \"no\":\n"], [], {"k:": {"max": ' || (event_id % 3) || '}}]}, "none": {}}' AS j FROM events),
           l AS (SELECT event_id, t.* FROM j, json_tree(j) t)
           SELECT event_id, replace(fullkey, '"', '') AS path, CASE WHEN type IN ('UBIGINT', 'BIGINT') THEN 'BIGINT' WHEN type = 'VARCHAR' THEN 'STRING' WHEN type = 'NULL' THEN 'VOID' ELSE type END AS kind, CASE WHEN type <> 'NULL' THEN atom->>'$' END AS value
           FROM l WHERE type NOT IN ('OBJECT', 'ARRAY')""")
def json_leaves(spark, d):
    e = load(spark, d, "events")
    j = F.concat(F.lit('{"p": '), "props", F.lit(', "who": {"id": '), F.col("user_id").cast("string"), F.lit(', "tags": ["'), "event_type", F.lit('", ['), F.col("event_id").cast("string"), F.lit(r', null, true, "say \"no\":\n"], [], {"k:": {"max": '), (F.col("event_id") % 3).cast("string"), F.lit('}}]}, "none": {}}'))
    return variants.leaf_rows(e.select("event_id", j.alias("j")), "j", ["event_id"])


@query("""SELECT k AS difficulty, count(*) AS n FROM (SELECT CASE WHEN event_id % 4 = 3 THEN NULL ELSE (props->>'$.k')::INTEGER END AS k FROM events) WHERE k IS NOT NULL AND k <> 0 GROUP BY 1""")
def difficulty_histogram(spark, d):
    n, k = F.col("event_id") % 4, F.get_json_object("props", "$.k")
    nothing = F.element_at(F.array(*map(F.lit, ("0", "0.0", "false", "[]", "{}", '""', "null", "-0e2"))), (F.col("user_id") % 8 + 1).cast("int"))
    j = F.when(n == 0, F.concat(F.lit('{"difficulty": '), k, F.lit("}"))).when(n == 1, F.concat(F.lit('{"difficulty": 0, "difficulty_level": " '), k, F.lit('"}'))).when(n == 2, F.concat(F.lit('{"difficulty": "", "metadata": {"difficulty": '), k, F.lit("}}"))).otherwise('{"difficulty": "hard"}')
    # A filter would be moved below the column and make it anew.
    rows = load(spark, d, "events").select(F.explode(F.filter(F.array(dashboard.difficulty(j)), lambda x: x != 0)).alias("difficulty"))
    return dashboard.most_common(rows, "difficulty")


@query("""SELECT bin, sum(n)::BIGINT AS n FROM (SELECT l_linenumber AS bin, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT p_size, count(*) FROM part WHERE p_size <= 7 GROUP BY 1) GROUP BY 1""")
def evidence_union(spark, d):
    a = load(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("bin")).agg(F.count("*").alias("n"))
    b = load(spark, d, "part").where("p_size <= 7").groupBy(F.col("p_size").alias("bin")).agg(F.count("*").alias("n"))
    return dashboard.added([a, b], "bin")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events),
          g AS (SELECT user_id, avg((event_type <> 'error')::INT) AS success, avg((event_type <> 'signup')::INT) AS complete, avg(value) FILTER (k <= 50) AS mean, list_sort(list(value) FILTER (k <= 50)) AS v FROM r GROUP BY 1)
          SELECT user_id, round(success, 6) AS success, round(complete, 6) AS complete, round(mean, 6) AS mean, round(CASE WHEN len(v) < 5 THEN mean ELSE v[least(floor(len(v) * 0.95)::INT + 1, len(v))] END, 6) AS p95,
          round(CASE WHEN success < 0.5 THEN 0.1 ELSE greatest(0.1, success * 10 / (1 + mean / 30) / 5) END, 6) AS weight FROM g""")
def provider_health(spark, d):
    rows = load(spark, d, "events").select("user_id", "event_id", "value", "event_type")
    out = dashboard.health(rows, "user_id", "event_id", F.col("event_type") != "error", "value", F.col("event_type") != "signup")
    weight = load_weight(F.col("success"), F.col("mean"), F.lit(2))
    return out.withColumn("weight", weight).select("user_id", *[F.round(c, 6).alias(c) for c in ("success", "complete", "mean", "p95", "weight")])


@query("SELECT count(*) AS probes, count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (event_type = 'error')::DOUBLE / count(*) AS rate, count(*) FILTER (event_type = 'error')::DOUBLE / count(*) > 0.3 AS blocked FROM events")
def preflight_gate(spark, d):
    return dashboard.blocked(load(spark, d, "events"), F.col("event_type") != "error")


@query("""SELECT o_custkey, sum(n)::BIGINT AS generated, sum(f)::BIGINT AS passed, string_agg(o_orderpriority || '=' || n, ',' ORDER BY o_orderpriority) AS engines
          FROM (SELECT o_custkey, o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY 1, 2) GROUP BY 1""")
def sampling_report(spark, d):
    out = dashboard.sampling_report(load(spark, d, "orders"), "o_custkey", {"passed": F.col("o_orderstatus") == "F"}, "o_orderpriority")
    entries = F.transform(F.map_entries("engines"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return out.select("o_custkey", "generated", "passed", F.array_join(entries, ",").alias("engines"))


@query("""SELECT o_orderstatus, actual, expected FROM (SELECT coalesce(a.o_orderstatus, e.s) AS o_orderstatus, coalesce(a.n, 0) AS actual, coalesce(e.n, 0) AS expected
          FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) a FULL JOIN (VALUES ('F', 10::BIGINT), ('X', 3::BIGINT)) e(s, n) ON a.o_orderstatus = e.s) WHERE actual <> expected""")
def baseline_check(spark, d):
    counts = load(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return dashboard.differences(counts, spark.createDataFrame([("F", 10), ("X", 3)], "o_orderstatus string, n long"), "o_orderstatus")


@query("SELECT count(*) AS files, count(*) FILTER (n_chars <= 400) AS small, count(*) > 50 AND count(*) FILTER (n_chars <= 400) > 0.2 * count(*) AS alert FROM documents")
def small_file_rate(spark, d):
    return dashboard.small_files(load(spark, d, "documents"), "n_chars", 400)


@query(r"""SELECT alert, n, n > most AS raised FROM (SELECT 'glyph' AS alert, count(*) FILTER (regexp_matches(text, 'Glyph.*missing')) AS n, 0 AS most FROM conversations UNION ALL SELECT 'blank', count(*) FILTER (contains(text, '空白图片')), 5 FROM conversations
           UNION ALL SELECT 'traceback', count(*) FILTER (regexp_matches(text, 'Traceback|RuntimeError|MemoryError|OSError|Segmentation')), 0 FROM conversations UNION ALL SELECT 'api', count(*) FILTER (regexp_matches(text, '401|403|500|502|503')), 3 FROM conversations
           UNION ALL SELECT 'timeout', count(*) FILTER (regexp_matches(text, 'timed out|Timeout')), 5 FROM conversations)""")
def log_alerts(spark, d):
    return dashboard.log_alerts(load(spark, d, "conversations"), "text")


@query("""SELECT o_custkey, round(CASE WHEN s >= 60 THEN n / (s / 3600) ELSE 0 END, 6) AS per_hour, round(CASE WHEN n > 0 AND s >= 60 THEN (100 - n) / (n / (s / 3600)) END, 6) AS hours_left, CASE WHEN n >= 10 * 0.95 THEN 'READY' ELSE 'PARTIAL' END AS readiness,
          round(n / greatest(1.0, (n % 3) * 720.0 / 2), 2) AS ratio, n / greatest(1.0, (n % 3) * 720.0 / 2) > 2.0 AS throttle FROM (SELECT o_custkey, count(*) AS n, (count(*) % 4 * 1800)::DOUBLE AS s FROM orders GROUP BY 1)""")
def throughput_eta(spark, d):
    rows = load(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    t = dashboard.throughput(F.col("n"), (F.col("n") % 4 * 1800).cast("double"), F.lit(100))
    b = dashboard.backpressure(F.col("n"), F.col("n") % 3)
    return rows.select("o_custkey", F.round(t["per_hour"], 6).alias("per_hour"), F.round(t["hours_left"], 6).alias("hours_left"), dashboard.ready(F.col("n"), F.lit(10)).alias("readiness"), b["ratio"].alias("ratio"), b["throttle"].alias("throttle"))


@query("""SELECT round(avg(r), 6) AS mean, CASE WHEN avg(r) >= 95 THEN 'up' WHEN avg(r) < 80 THEN 'down' ELSE 'stay' END AS scale FROM (SELECT user_id, 100.0 * avg((event_type <> 'error')::INT) AS r FROM events GROUP BY 1)""")
def scale_decision(spark, d):
    rates = load(spark, d, "events").groupBy("user_id").agg((100 * F.avg((F.col("event_type") != "error").cast("double"))).alias("rate"))
    return dashboard.scale(rates, "rate", F.lit(5)).withColumn("mean", F.round("mean", 6))


@query("""SELECT r_name AS subject_id, count(DISTINCT n_nationkey)::INTEGER AS modules, count(c_custkey)::INTEGER AS points, (SELECT count(*) FROM region) = 5 AS complete
          FROM region LEFT JOIN nation ON r_regionkey = n_regionkey LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY 1""")
def taxonomy_sizes(spark, d):
    modules = load(spark, d, "region").join(load(spark, d, "nation"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    points = modules.join(load(spark, d, "customer"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return dashboard.taxonomy_counts(points, "r_name", "n_nationkey", "c_custkey", 5)


@query("SELECT event_type, round(sum(value), 4) AS total FROM events GROUP BY 1")
def named_counters(spark, d):
    return dashboard.counters(load(spark, d, "events"), "event_type", F.col("value")).withColumn("total", F.round("total", 4))


@query("""WITH m AS (SELECT event_id, user_id, ts, value, max(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM events),
          l AS (SELECT *, max(CASE WHEN b IS NULL OR value > b THEN ts END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS last FROM m)
          SELECT event_id, (epoch(date_trunc('second', ts)) - epoch(date_trunc('second', last)))::BIGINT AS seconds, epoch(date_trunc('second', ts)) - epoch(date_trunc('second', last)) >= 600 AS stalled FROM l""")
def no_growth(spark, d):
    return dashboard.no_growth(load(spark, d, "events").select("event_id", "user_id", "ts", "value"), ["user_id"], "ts", "value").select("event_id", "seconds", "stalled")


@query("""WITH s AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'view') AS c FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) WHERE k <= 5 GROUP BY 1)
          SELECT round(sum(c)::DOUBLE / sum(n), 6) AS accuracy, round(avg((c = n)::INT), 6) AS all_correct, round(avg((c >= n // 2 + 1)::INT), 6) AS majority FROM s""")
def run_accuracy(spark, d):
    rows = windows.numbered(load(spark, d, "events"), ["user_id"], ["event_id"], "idx").where("idx <= 5")
    return dashboard.overall_accuracy(rollouts.majority(rows.select(F.col("user_id").alias("item"), "idx", F.col("event_type").alias("answer"), F.lit("view").alias("key"))))


@query("""WITH i AS (SELECT p_partkey, unnest(range(0, least(p_size, 12))) AS i, (p_size % 6)::DOUBLE AS imp FROM part)
          SELECT p_partkey, (i + 1)::INTEGER AS slot, CASE WHEN (i + 1) % 6 = 0 THEN 'en' ELSE 'zh' END AS language, (CASE WHEN imp >= 4.5 THEN [3,4,4,5,3,4,5,4] WHEN imp >= 3.5 THEN [2,3,3,4,3,4,2,3] WHEN imp >= 2.5 THEN [2,3,3,2,4,3,2,3] ELSE [1,2,2,3,2,3,1,2] END)[1 + i % 8]::INTEGER AS difficulty,
          ['read', 'compare', 'derive'][1 + i % 3] AS archetype, ['diagram', 'table', 'chart', 'map'][1 + (i + i // 3) % 4] AS image_type, ['logic', 'calculation'][1 + i % 2] AS competency FROM i""")
def blueprint(spark, d):
    rows = load(spark, d, "part").select("p_partkey", F.least("p_size", F.lit(12)).alias("quota"), (F.col("p_size") % 6).cast("double").alias("importance"))
    out = windows.blueprint(rows, "quota", gates.difficulty_pattern(F.col("importance")), ["read", "compare", "derive"], ["diagram", "table", "chart", "map"], ["logic", "calculation"])
    return out.select("p_partkey", "slot", "language", "difficulty", "archetype", "image_type", "competency")


@query("""WITH q AS (SELECT s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS k, (s_suppkey % 7 + 1)::BIGINT AS have FROM supplier),
          t AS (SELECT *, sum(have) OVER (PARTITION BY s_nationkey) AS done FROM q), o AS (SELECT *, greatest(0, 30 - done) AS rest, count(*) FILTER (k <= 2) OVER (PARTITION BY s_nationkey) AS n FROM t WHERE done < 30),
          f AS (SELECT *, CASE WHEN rest >= n THEN 1 ELSE 0 END AS base FROM o WHERE k <= 2), r AS (SELECT *, (rest - base * n) / n AS raw FROM f), l AS (SELECT *, floor(raw) AS fl, raw - floor(raw) AS fr, rest - sum(base + floor(raw)) OVER (PARTITION BY s_nationkey) AS left_ FROM r)
          SELECT s_nationkey, s_suppkey, have, (have + base + fl + CASE WHEN row_number() OVER (PARTITION BY s_nationkey ORDER BY fr DESC, s_suppkey) <= left_ THEN 1 ELSE 0 END)::BIGINT AS quota FROM l""")
def deficit_queue(spark, d):
    rows = load(spark, d, "supplier").select("s_nationkey", "s_suppkey", (F.col("s_suppkey") % 7 + 1).alias("have"))
    return progress.custom_deficits(rows, "s_nationkey", "s_suppkey", "have", 30, 2).select("s_nationkey", "s_suppkey", "have", "quota")


@query(f"""WITH r AS (SELECT event_id, user_id, CASE {STATUSES} WHEN 'GENERATED' THEN 'review' WHEN 'ACCEPTED' THEN 'image' END AS queue, ts FROM events),
           n AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY ts, event_id) AS k FROM r WHERE queue IS NOT NULL) SELECT event_id, queue FROM n WHERE k <= 500""")
def orphan_recovery(spark, d):
    return stages.recovery(_records(spark, d), ["ts"], "event_id").select("event_id", "queue")


@query("""SELECT event_id, attempt::INTEGER AS attempt, CASE WHEN attempt <= 3 THEN 'RETRY' ELSE 'HOLD' END AS status, CASE WHEN attempt <= 3 THEN ts + to_seconds(least(30, 5 * attempt)) END AS retry_at
          FROM (SELECT event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS attempt FROM events WHERE event_type = 'error')""")
def delayed_retries(spark, d):
    rows = load(spark, d, "events").where("event_type = 'error'").select("event_id", "user_id", "ts")
    return stages.retry_plan(rows, "user_id", "event_id", "ts").select("event_id", "attempt", "status", "retry_at")


@query("""WITH z AS (SELECT event_id, (value / 100 >= 0.3)::INT + (value / 100 >= 0.5)::INT + (value / 100 >= 0.7)::INT + (value / 100 >= 0.8)::INT AS zone, value FROM events)
          SELECT event_id, [12, 12, 12, 8, 8][zone + 1]::INTEGER AS review, [32, 24, 16, 8, 8][zone + 1]::INTEGER AS generate, CASE WHEN value / 500 < 0.05 THEN 9 WHEN value / 500 < 0.15 THEN 25 ELSE 38 END::INTEGER AS image FROM z""")
def throttle_slots(spark, d):
    slots = stages.slots_of(gates.zone(F.col("value") / 100), F.col("value") / 500)
    return load(spark, d, "events").select("event_id", slots.alias("s")).select("event_id", "s.review", "s.generate", "s.image")


@query("""SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 120 AS admitted FROM events""")
def bounded_admission(spark, d):
    return stages.admitted(load(spark, d, "events").select("event_id", "event_type", "ts"), ["event_type"], ["ts", "event_id"], F.lit(120)).select("event_id", "admitted")


@query("""WITH c AS (SELECT time_bucket(INTERVAL '15 minutes', ts)::TIMESTAMP AS start, count(*) AS n, sum(value) AS total FROM events GROUP BY 1),
          g AS (SELECT unnest(generate_series((SELECT min(start) FROM c), (SELECT max(start) FROM c), INTERVAL '15 minutes')) AS start)
          SELECT g.start, coalesce(n, 0) AS n, round(coalesce(total, 0), 4) AS total, n IS NULL AS heartbeat FROM g LEFT JOIN c USING (start)""")
def period_report(spark, d):
    out = stages.period_report(load(spark, d, "events"), "ts", "value")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "n", F.round("total", 4).alias("total"), "heartbeat")


@query("""WITH l AS (SELECT event_id, user_id, CASE WHEN event_type = 'purchase' THEN 'CRITICAL' WHEN event_type = 'error' THEN 'ERROR' ELSE 'WARNING' END AS level FROM events),
          c AS (SELECT *, sum((level <> 'CRITICAL')::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM l) SELECT event_id, level = 'CRITICAL' OR (level = 'ERROR' AND n >= 5) AS paused FROM c""")
def incident_pauses(spark, d):
    t = F.col("event_type")
    level = F.when(t == "purchase", "CRITICAL").when(t == "error", "ERROR").otherwise("WARNING")
    return windows.escalated(load(spark, d, "events").select("event_id", "user_id", level.alias("level")), ["user_id"], ["event_id"], "level").select("event_id", "paused")


@query(r"""SELECT o_orderkey, o_orderkey % 6 AS wrong, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE (o_orderkey % 6)::VARCHAR || ':' || 'A,B' END AS parsed, 'rollout correct=' || (5 - o_orderkey % 6) || ' wrong=' || (o_orderkey % 6) || ' answers=A,B' AS detail FROM orders""")
def rollout_details(spark, d):
    w = F.col("o_orderkey") % 6
    made = T.format_detail(F.lit("rollout"), w, 5 - w, F.array(F.lit("A"), F.lit("B")), True)
    other = T.format_detail(F.lit("rollout"), w, 5 - w, F.array(F.lit("A"), F.lit("B")))
    read = T.rollout_detail(F.when(F.col("o_orderkey") % 4 != 0, made))
    return load(spark, d, "orders").select("o_orderkey", w.alias("wrong"), F.concat(read["wrong"].cast("string"), F.lit(":"), F.array_join(read["answers"], ",")).alias("parsed"), other.alias("detail"))


@query("""WITH r AS (SELECT conv_id AS item, turn::INTEGER AS idx, text, (conv_id + turn) % 5 AS k FROM conversations)
          SELECT item, idx, CASE WHEN k IN (0, 1, 2) THEN coalesce(text, '') WHEN k = 4 THEN '' END AS answer,
                 CASE WHEN k = 3 THEN 'failed' WHEN k = 4 OR coalesce(text, '') = '' THEN 'empty' ELSE 'ok' END AS status FROM r""")
def recorded_answers(spark, d):
    """Conversations recorded as a service's replies, of two forms and with failures, replayed by the data source."""
    said = load(spark, d, "conversations")
    kinds = F.element_at(F.array(*map(F.lit, ("choices", "parts", "choices", "error", "none"))), (F.pmod(F.col("conv_id") + F.col("turn"), F.lit(5)) + 1).cast("int"))
    recording = written(said.select(F.col("conv_id").alias("item"), F.col("turn").cast("int").alias("idx"), recorded.reply(F.col("text"), kinds).alias("body")), "recording")
    recorded.register(spark)
    folder = recording.inputFiles()[0].rsplit("/", 1)[0]
    return spark.read.format("recorded_answers").load(folder).select("item", "idx", "answer", "status")
