"""The engine's operators as queries over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from examlake.functions import text as T
from examlake.operators import arrays, dashboard, gates, phrases, progress, reconcile, rollouts, sampling, state, windows
from examlake.plans import orders, records, rest, rules  # noqa: F401  they register queries of their own
from examlake.plans.registry import NOT_WORD, ORACLE_SQL, QUERIES, query  # noqa: F401
from examlake.sources.tables import load
from examlake.streaming import jobs

DRIVER_WORDS = ("the", "and")


@query("""SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
          count(*) FILTER (o_orderstatus = 'P') AS "P", count(*) AS total FROM orders GROUP BY 1""")
def progress_matrix(spark, d):
    return progress.progress_matrix(load(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("""SELECT o_custkey, count(*) AS generated, count(*) FILTER (o_orderstatus IN ('F', 'O')) AS passed,
          count(*) FILTER (o_orderstatus = 'P') AS failed FROM orders GROUP BY 1""")
def status_rollup(spark, d):
    return progress.status_rollup(load(spark, d, "orders"), "o_custkey", "o_orderstatus", {"passed": ["F", "O"], "failed": ["P"]})


@query("""WITH have AS (SELECT l_partkey AS p_partkey, count(*) AS done FROM lineitem GROUP BY 1),
          q AS (SELECT p_brand, p_partkey, p_size::BIGINT AS quota FROM part)
          SELECT p_brand, sum(quota)::BIGINT AS quota, sum(coalesce(done, 0))::BIGINT AS done, sum(greatest(0, quota - coalesce(done, 0)))::BIGINT AS need
          FROM q LEFT JOIN have USING (p_partkey) GROUP BY ROLLUP (p_brand)""")
def deficit_rollup(spark, d):
    have = load(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("done"))
    quotas = load(spark, d, "part").select("p_brand", "p_partkey", F.col("p_size").cast("long").alias("quota"))
    return progress.deficits(have, quotas, ["p_partkey"]).rollup("p_brand").agg(*[F.sum(c).alias(c) for c in ("quota", "done", "need")])


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1")
def latest_event_per_user(spark, d):
    return state.latest(load(spark, d, "events"), "user_id", "event_id", ["event_type", "value"])


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def resume_anti_join(spark, d):
    return reconcile.pending(load(spark, d, "documents").select("doc_id", "lang", "source"), load(spark, d, "labels").where("quality = 1"), "doc_id")


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def verified_semi_join(spark, d):
    return reconcile.verified(load(spark, d, "documents").select("doc_id", "lang", "source"), load(spark, d, "labels").where("quality = 1"), "doc_id")


@query("""SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'missing' WHEN a.doc_id IS NULL THEN 'extra' ELSE 'matched' END AS state
          FROM (SELECT doc_id FROM documents WHERE lang = 'en') a FULL JOIN labels b ON a.doc_id = b.doc_id""")
def reconcile_refs(spark, d):
    return reconcile.references(load(spark, d, "documents").where("lang = 'en'"), load(spark, d, "labels"), ["doc_id"])


@query("""SELECT c_custkey, c_nationkey, coalesce(n_name, 'not_in_questions') AS n_name FROM customer
          LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 1) ON c_nationkey = n_nationkey""")
def lookup_default(spark, d):
    names = load(spark, d, "nation").where("n_regionkey <> 1").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return reconcile.looked_up(load(spark, d, "customer").select("c_custkey", "c_nationkey"), names, "c_nationkey", "n_name", "not_in_questions")


@query(r"""WITH t AS (SELECT doc_id, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS t FROM documents),
           p AS (SELECT item_id, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS p FROM benchmark)
           SELECT doc_id, item_id FROM t JOIN p ON contains(t, p) AND length(p) >= 8""")
def protected_phrase_leak(spark, d):
    texts = load(spark, d, "documents").select("doc_id", T.normalised(F.col("text")).alias("t"))
    guarded = load(spark, d, "benchmark").select("item_id", T.normalised(F.col("text")).alias("p"))
    return phrases.leaks(texts, guarded, "t", "p", "doc_id", "item_id")


@query(r"""SELECT doc_id, len(list_filter(regexp_split_to_array(regexp_replace(text, '[\x{4e00}-\x{9fff}]+', ' ZH ', 'g'), '[\s\x{0b}\x{85}\x{a0}]+'), lambda x: x <> ''))::INTEGER AS words FROM documents""")
def word_count_mixed(spark, d):
    return load(spark, d, "documents").select("doc_id", T.mixed_words(F.col("text")).alias("words"))


@query(rf"""SELECT doc_id, regexp_matches(text, '[\x00-\x08\x0b\x0c\x0e-\x1f]') AS control, (length(text) - length(replace(text, '$', ''))) % 2 <> 0 AS unbalanced,
           regexp_matches(text, '(?i)(^|{NOT_WORD})(the|and)($|{NOT_WORD})') AS vague, regexp_matches(trim(text), '(?i)^(the|an)') AS opens FROM documents""")
def text_checks(spark, d):
    t = F.col("text")
    return load(spark, d, "documents").select("doc_id", T.control_chars(t).alias("control"), T.unbalanced(t).alias("unbalanced"), T.has_word(t, DRIVER_WORDS).alias("vague"), T.opens_with(t, ("the", "an")).alias("opens"))


@query(rf"""WITH c AS (SELECT doc_id, trim(text) = '' AS empty, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS w,
             (length(text) - length(replace(text, '$', ''))) % 2 <> 0 AS odd, regexp_matches(text, '(?i)(^|{NOT_WORD})(the|and)($|{NOT_WORD})') AS vague FROM documents)
           SELECT doc_id, array_to_string(list_filter([CASE WHEN empty THEN 'empty' END, CASE WHEN w < 50 THEN 'too_short' END, CASE WHEN w > 200 THEN 'too_long' END,
             CASE WHEN odd THEN 'unbalanced_math' END, CASE WHEN vague THEN 'vague_word' END], lambda x: x IS NOT NULL), ',') AS issues,
             NOT (empty OR w < 50 OR w > 200 OR odd OR vague) AS passed FROM c""")
def gate_issue_array(spark, d):
    out = gates.prompt_gate(load(spark, d, "documents"), "text", vague=DRIVER_WORDS)
    return out.select("doc_id", F.array_join("issues", ",").alias("issues"), "passed")


@query(rf"""SELECT conv_id, turn, coalesce(nullif(regexp_extract(upper(trim(text)), '(?:^|{NOT_WORD})([ABCD])(?:$|{NOT_WORD})', 1), ''), '') AS strict,
           regexp_extract(upper(trim(text)), '[ABCD]', 0) AS lax FROM conversations""")
def answer_extract(spark, d):
    t = F.col("text")
    return load(spark, d, "conversations").select("conv_id", "turn", T.answer_strict(t).alias("strict"), T.answer_lax(t).alias("lax"))


def _rollouts(spark, d):
    numbered = windows.numbered(load(spark, d, "events"), ["user_id"], ["event_id"], "idx").where("idx <= 5")
    answer = F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type"))
    key = F.element_at(F.array(*map(F.lit, ("click", "view", "purchase"))), (F.pmod(F.col("user_id"), F.lit(3)) + 1).cast("int"))
    return numbered.select(F.col("user_id").alias("item"), "idx", answer.alias("answer"), key.alias("key"))


ROLLOUTS = """r AS (SELECT user_id AS item, idx, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS answer, ['click', 'view', 'purchase'][1 + user_id % 3] AS key
              FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS idx FROM events) WHERE idx <= 5)"""


@query(f"""WITH {ROLLOUTS}, s AS (SELECT item, count(*) FILTER (answer <> '' AND answer = key) AS correct_count, count(*) FILTER (answer <> '' AND answer <> key) AS wrong_count,
           count(*) FILTER (answer <> '') AS valid_count FROM r GROUP BY 1)
           SELECT *, CASE WHEN valid_count < 5 THEN 'TECH_FAIL' WHEN wrong_count >= 3 THEN 'PASS' ELSE 'FAIL' END AS decision FROM s""")
def rollout_full5(spark, d):
    return rollouts.full(_rollouts(spark, d))


@query(f"""WITH {ROLLOUTS}, c AS (SELECT *, sum((answer <> '' AND answer <> key)::INT) OVER w AS cw, sum((answer <> '' AND answer = key)::INT) OVER w AS cc FROM r WINDOW w AS (PARTITION BY item ORDER BY idx)),
           m AS (SELECT *, coalesce(bool_or(cw >= 3 OR cc > 2) OVER (PARTITION BY item ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stopped FROM c),
           s AS (SELECT item, count(*) AS calls, max(cw)::BIGINT AS wrong_count, max(cc)::BIGINT AS correct_count, count(*) FILTER (answer <> '') AS valid_count FROM m WHERE NOT stopped GROUP BY 1)
           SELECT *, CASE WHEN valid_count < calls THEN 'TECH_FAIL' WHEN wrong_count >= 3 THEN 'PASS' ELSE 'FAIL' END AS decision FROM s""")
def rollout_early_stop(spark, d):
    return rollouts.early_stopped(_rollouts(spark, d))


@query(f"""WITH {ROLLOUTS}, s AS (SELECT item, count(*) FILTER (answer <> '' AND answer <> key) AS wrong_count FROM r GROUP BY 1)
           SELECT b.wrong_count, count(s.item) AS n FROM (SELECT unnest(range(0, 6)) AS wrong_count) b LEFT JOIN s USING (wrong_count) GROUP BY 1""")
def wrong_histogram(spark, d):
    return progress.histogram(rollouts.full(_rollouts(spark, d)), "wrong_count", spark.range(6).withColumnRenamed("id", "wrong_count"))


@query(f"WITH {ROLLOUTS}, s AS (SELECT item, count(*) AS n, count(*) FILTER (answer = key) AS c FROM r GROUP BY 1) SELECT item, n, c, c = n AS all_correct, c >= n // 2 + 1 AS majority FROM s")
def majority_accuracy(spark, d):
    return rollouts.majority(_rollouts(spark, d))


@query("""SELECT CASE WHEN event_type = 'error' THEN CASE WHEN value > 50 THEN 'technical failure' WHEN value > 20 THEN 'too easy' ELSE 'render failure' END WHEN event_type = 'click' THEN 'pending' ELSE 'hold' END AS class,
          count(*) AS n FROM events WHERE event_type IN ('error', 'view', 'click') GROUP BY 1""")
def failure_classes(spark, d):
    note = F.when(F.col("event_type") == "error", F.when(F.col("value") > 50, "Qwen_technical: timeout").when(F.col("value") > 20, "candidate_quality_fail").otherwise("render has FAILed"))
    status = F.when(F.col("event_type") == "view", "HOLD").when(F.col("event_type") == "click", "REGENERATE").otherwise("FINAL_PASS")
    kinds = load(spark, d, "events").select(dashboard.failure_class(note, status).alias("class")).where("class is not null")
    return dashboard.most_common(kinds, "class")


@query("""WITH n AS (SELECT o_orderkey, o_orderpriority, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1) // 100 AS chunk FROM orders),
          f AS (SELECT *, count(*) OVER (PARTITION BY o_orderpriority, chunk) AS c FROM n) SELECT o_orderkey, o_orderpriority, chunk FROM f WHERE c = 100""")
def milestone_bucket(spark, d):
    rows = load(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return windows.complete_chunks(rows, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], 100, split=True).drop("o_orderdate")


@query("""WITH n AS (SELECT o_orderkey, o_custkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1) // 10 AS chunk FROM orders),
          f AS (SELECT *, count(*) OVER (PARTITION BY o_custkey, chunk) AS c FROM n) SELECT o_orderkey, o_custkey, chunk FROM f WHERE c = 10""")
def chunk_export(spark, d):
    rows = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return windows.complete_chunks(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], 10).drop("o_orderdate")


@query("""WITH z AS (SELECT event_id, user_id, CASE WHEN value / 100 < 0.3 THEN 0 WHEN value / 100 < 0.5 THEN 1 WHEN value / 100 < 0.7 THEN 2 WHEN value / 100 < 0.8 THEN 3 ELSE 4 END AS zone FROM events),
          c AS (SELECT *, coalesce((zone <> lag(zone) OVER w)::INT, 1) AS ch FROM z WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
          r AS (SELECT *, sum(ch) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM c)
          SELECT event_id, user_id, zone, row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) >= 3 AS acted FROM r""")
def hysteresis_zone(spark, d):
    rows = load(spark, d, "events").select("event_id", "user_id", gates.zone(F.col("value") / 100).alias("zone"))
    return windows.settled(rows, ["user_id"], ["event_id"], "zone")


@query("""WITH e AS (SELECT event_id, user_id, event_type, value FROM events)
          SELECT event_id, user_id, count(*) OVER w = 3 AND min(event_type) OVER w = max(event_type) OVER w AND value > 10 AS stalled FROM e
          WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def stall_windows(spark, d):
    rows = load(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return windows.stalled(rows, ["user_id"], ["event_id"], ["event_type"], F.col("value") > 10, 3).select("event_id", "user_id", "stalled")


@query("""WITH i AS (SELECT event_id, user_id, (event_type = 'error')::INT AS hit, sum((event_type <> 'error')::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM events)
          SELECT event_id, user_id, sum(hit) OVER (PARTITION BY user_id, island ORDER BY event_id)::BIGINT AS run_length FROM i""")
def error_islands(spark, d):
    return windows.islands(load(spark, d, "events").select("event_id", "user_id", "event_type"), ["user_id"], ["event_id"], F.col("event_type") == "error").drop("event_type")


@query("""WITH w AS (SELECT event_id, user_id, list_sort(list(value) OVER w) AS v FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))
          SELECT event_id, user_id, round(list_avg(v), 8) AS mean, round(CASE WHEN len(v) < 5 THEN list_avg(v) ELSE v[least(floor(len(v) * 0.95)::INT + 1, len(v))] END, 8) AS p95 FROM w""")
def trailing_p95(spark, d):
    out = windows.trailing(load(spark, d, "events").select("event_id", "user_id", "value"), ["user_id"], ["event_id"], "value")
    return out.select("event_id", "user_id", F.round("mean", 8).alias("mean"), F.round("p95", 8).alias("p95"))


@query("""WITH s AS (SELECT s_nationkey, s_suppkey, greatest(0, floor(s_acctbal)::BIGINT) AS weight FROM supplier),
          b AS (SELECT *, count(*) OVER g AS n, sum(weight) OVER g AS ws FROM s WINDOW g AS (PARTITION BY s_nationkey)),
          r AS (SELECT *, CASE WHEN 30 >= n THEN 1 ELSE 0 END AS base, (30 - CASE WHEN 30 >= n THEN n ELSE 0 END) * CASE WHEN ws > 0 THEN weight::DOUBLE / ws ELSE 1.0 / n END AS raw FROM b),
          f AS (SELECT *, floor(raw) AS fl, raw - floor(raw) AS fr, 30 - sum(base + floor(raw)) OVER (PARTITION BY s_nationkey) AS rest FROM r)
          SELECT s_nationkey, s_suppkey, weight, (base + fl + CASE WHEN row_number() OVER (PARTITION BY s_nationkey ORDER BY fr DESC, weight DESC, s_suppkey) <= rest THEN 1 ELSE 0 END)::BIGINT AS share FROM f""")
def apportion_largest_remainder(spark, d):
    rows = load(spark, d, "supplier").select("s_nationkey", "s_suppkey", F.greatest(F.lit(0).cast("long"), F.floor("s_acctbal")).alias("weight"))
    return progress.apportioned(rows, ["s_nationkey"], F.lit(30), "weight", "s_suppkey")


@query("""SELECT p_partkey, slot::INTEGER AS slot, ['easy', 'medium', 'hard'][1 + (slot - 1) % 3] AS difficulty, ['diagram', 'table', 'chart', 'map'][1 + (slot - 1) % 4] AS image_type
          FROM (SELECT p_partkey, unnest(generate_series(1, p_size)) AS slot FROM part)""")
def blueprint_slots(spark, d):
    cycles = {"difficulty": ["easy", "medium", "hard"], "image_type": ["diagram", "table", "chart", "map"]}
    return windows.slots(load(spark, d, "part").select("p_partkey", "p_size"), "p_size", cycles).drop("p_size")


@query("""WITH r AS (SELECT p_brand, p_partkey, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS rank FROM part)
          SELECT p_brand, p_partkey, p_size, rank::INTEGER AS rank, (CASE WHEN p_size <= 0 THEN 0 WHEN p_size <= 5 THEN p_size + 3 WHEN p_size <= 20 THEN trunc(p_size * 1.5 + 0.999) ELSE trunc(p_size * 1.3 + 0.999) END)::INTEGER AS planned FROM r WHERE rank <= 3""")
def topn_need_per_group(spark, d):
    rows = load(spark, d, "part").select("p_brand", "p_partkey", "p_size")
    return progress.top_per_group(rows, ["p_brand"], [F.desc("p_size"), F.asc("p_partkey")], 3).withColumn("planned", progress.over_provisioned(F.col("p_size")))


@query("""WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY (doc_id * 2654435761) % 4294967296, doc_id) AS rank FROM documents)
          SELECT source, doc_id, rank::INTEGER AS rank FROM r WHERE rank <= 5""")
def stratified_hash_sample(spark, d):
    return sampling.stratified(load(spark, d, "documents").select("source", "doc_id"), "source", "doc_id", 5)


@query("SELECT time_bucket(INTERVAL '15 minutes', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_15min(spark, d):
    events = load(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("kind"), "value")
    return jobs.period_counts(events).select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("kind").alias("event_type"), "n")


@query("SELECT user_id, arg_min(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, count(*) AS writes FROM events GROUP BY 1")
def upsert_fold(spark, d):
    return state.upsert_fold(load(spark, d, "events"), "user_id", "event_id", ["event_type"], ["value"])


@query("SELECT event_id, (props->>'$.k')::INTEGER AS k FROM events")
def json_props(spark, d):
    return load(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k"))


@query("""SELECT vec_id, len(embedding)::INTEGER AS n, list_max(embedding)::DOUBLE AS top, list_min(embedding)::DOUBLE AS low,
          len(list_distinct(list_transform(embedding, lambda x: floor(x::DOUBLE / 0.25))))::INTEGER AS levels, len(list_filter(embedding, lambda x: x > 0))::INTEGER AS positive FROM embeddings""")
def array_stats(spark, d):
    e = F.transform("embedding", lambda x: x.cast("double"))
    return load(spark, d, "embeddings").select("vec_id", F.size("embedding").alias("n"), F.array_max(e).alias("top"), F.array_min(e).alias("low"), arrays.levels(e, 0.25).alias("levels"), F.size(F.filter(e, lambda x: x > 0)).alias("positive"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey <> 7)")
def fk_check(spark, d):
    good = load(spark, d, "supplier").where("s_nationkey <> 7")
    return state.orphans(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), good, "l_suppkey", "s_suppkey").drop("l_suppkey")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def enum_check(spark, d):
    return load(spark, d, "orders").select("o_orderkey", "o_orderstatus").where(state.outside(F.col("o_orderstatus"), ["F", "O"]))


@query("""SELECT n_name, count(c_custkey) AS question_count, count(*) FILTER (c_acctbal >= 0) AS image_count,
          CASE WHEN count(*) FILTER (c_acctbal < 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY 1""")
def export_index(spark, d):
    rows = load(spark, d, "nation").join(load(spark, d, "customer"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    bad = F.count_if(F.col("c_acctbal") < 0)
    return rows.groupBy("n_name").agg(F.count("c_custkey").alias("question_count"), F.count_if(F.col("c_acctbal") >= 0).alias("image_count"), F.when(bad == 0, "PASS").otherwise("FAIL").alias("status"))


@query("""SELECT event_id, CASE event_type WHEN 'view' THEN 'image' WHEN 'click' THEN CASE WHEN value > 50 THEN 'review' ELSE 'regen' END WHEN 'error' THEN 'regen' ELSE 'skip' END AS route FROM events""")
def recycle_route(spark, d):
    status = F.when(F.col("event_type") == "view", "RENDER_FAIL").when(F.col("event_type") == "click", "HOLD").when(F.col("event_type") == "error", "SENTINEL_REGEN").otherwise("FINAL_PASS")
    return load(spark, d, "events").select("event_id", gates.routed(status, F.col("value") > 50).alias("route"))


@query(r"""SELECT p_partkey, substr(regexp_replace(p_name, '[^\p{L}\p{N}_-]', '_', 'g'), 1, 80) AS file_name, regexp_replace(k, '-[^-]*$', '') AS module, split_part(k, '-M', 1) AS subject, split_part(k, '-', 3) AS last
           FROM (SELECT p_partkey, p_name, 'S' || lpad((p_size % 24)::VARCHAR, 2, '0') || '-M' || lpad((p_partkey % 7)::VARCHAR, 2, '0') || '-' || p_partkey AS k FROM part)""")
def key_helpers(spark, d):
    part = load(spark, d, "part").withColumn("k", F.format_string("S%02d-M%02d-%d", F.col("p_size") % 24, F.col("p_partkey") % 7, "p_partkey"))
    k = F.col("k")
    return part.select("p_partkey", T.file_name(F.col("p_name")).alias("file_name"), T.key_module(k).alias("module"), T.key_subject(k).alias("subject"), T.key_last(k).alias("last"))


#: j is a JSON column and id its key; every reason, with the record parsed.
REASONS = r"""v AS (SELECT *, CASE WHEN json_valid(j) THEN json_type(j) END AS kind, CASE WHEN json_valid(j) THEN coalesce(j->>'$.question_text', '') ELSE '' END AS t FROM r),
           c AS (SELECT *, regexp_matches(t, '\\[A-Za-z(\[]|\$\$|(^|[^\\])\$') AS signal FROM v)
           SELECT id, CASE WHEN trim(j) = '' THEN 'empty_question_json' ELSE array_to_string(list_filter([CASE WHEN regexp_matches(j, '[\x00-\x08\x0b\x0c\x0e-\x1f]') THEN 'illegal_control_char:U+0001' END,
             CASE WHEN NOT json_valid(j) THEN 'json_parse_error' END, CASE kind WHEN 'ARRAY' THEN 'invalid_question_json_type:list' WHEN 'VARCHAR' THEN 'invalid_question_json_type:str' END,
             CASE WHEN kind = 'OBJECT' AND signal AND length(replace(t, '\(', '')) <> length(replace(t, '\)', '')) THEN 'unbalanced_latex_inline_delimiter' END,
             CASE WHEN kind = 'OBJECT' AND signal AND length(replace(t, '\[', '')) <> length(replace(t, '\]', '')) THEN 'unbalanced_latex_display_delimiter' END,
             CASE WHEN kind = 'OBJECT' AND signal AND (length(t) - length(replace(t, '$$', ''))) // 2 % 2 <> 0 THEN 'unbalanced_latex_double_dollar' END], lambda x: x IS NOT NULL), ',') END AS reasons FROM c"""

#: Question texts put into events.props, in JSON; the last rows are no record at all.
TEXTS = [r"costs $5", r"open $$x", r"$$x$$", r"\\( x", r"no sign \\)", r"\\frac x \\)", r"a \\[ x \\]"]


@query(f"WITH r AS (SELECT page_id AS id, html AS j FROM pages), {REASONS}")
def quarantine_pages(spark, d):
    return gates.quarantine(load(spark, d, "pages").select(F.col("page_id").alias("id"), "html"), "html").select("id", F.array_join("reasons", ",").alias("reasons"))


@query("""WITH r AS (SELECT event_id AS id, CASE event_id % 13 """ + " ".join(f"WHEN {i} THEN replace(props, '}}', ', \"question_text\": \"{t}\"}}')" for i, t in enumerate(TEXTS)) + f"""
             WHEN 7 THEN '' WHEN 8 THEN '[' || props || ']' WHEN 9 THEN props || '}}' WHEN 10 THEN replace(props, 'k', 'k' || chr(1)) WHEN 11 THEN '"' || event_id || '"' ELSE props END AS j FROM events), {REASONS}""")
def quarantine_records(spark, d):
    n, props = F.col("event_id") % 13, F.col("props")
    j = F.when(n == 7, "").when(n == 8, F.concat(F.lit("["), props, F.lit("]"))).when(n == 9, F.concat(props, F.lit("}"))).when(n == 10, F.replace(props, F.lit("k"), F.lit("k\x01"))).when(n == 11, F.concat(F.lit('"'), "event_id", F.lit('"')))
    for i, t in enumerate(TEXTS):
        j = j.when(n == i, F.replace(props, F.lit("}"), F.lit(f', "question_text": "{t}"}}')))
    rows = load(spark, d, "events").select(F.col("event_id").alias("id"), j.otherwise(props).alias("j"))
    return gates.quarantine(rows, "j").select("id", F.array_join("reasons", ",").alias("reasons"))
