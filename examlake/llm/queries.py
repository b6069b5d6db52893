"""One query per training-data operator, and SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examlake.llm import capfilters, centroids, huffman, importance, linededup, mixing, multiset_hash, pieces, quality, secret_scan, simhash, topk, warc
from examlake.llm.common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; rows as simhash.near_duplicates() has them: null and blank texts have
    fingerprint zero, ids may repeat or be null, an empty table gives none."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and checksums of every document's ids, read back from its files; rows as huffman.round_trip() has them."""
    return huffman.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)


def op3_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text; rows as multiset_hash.compared() has them."""
    return multiset_hash.compared(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives; rows as warc.write() has them."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every text; rows as secret_scan.scan() has them."""
    return secret_scan.digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded; rows as pieces.encoded() has them."""
    return pieces.digest(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every text; rows as quality.scored() has them."""
    return quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mixture takes of every document; rows that repeat an id within a source are one document, null
    and blank texts are of size 0, an empty table gives none."""
    return mixing.Plan(table(spark, sf_dir, "documents")).taken()


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of every query vector; rows as topk.top_k() has them."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup takes from every text; rows as linededup.deduplicated() has them."""
    return linededup.digest(table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every text; rows as importance.resampled() has them."""
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and distance of every kept vector; rows as centroids.cluster() has them."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def lloyd_sql(rounds: int = 10, k: int = 8, seed: int = 3) -> str:
    """The rounds one after another, each a pair of steps: nearest centroids, then their members' floored means."""
    near = """n{i} AS MATERIALIZED (SELECT vec_id, cluster, d FROM (
                SELECT v.vec_id, c.cluster, list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d,
                       row_number() OVER (PARTITION BY v.vec_id ORDER BY d, c.cluster) AS r FROM v, c{i} c) WHERE r = 1)"""
    mean = """c{j} AS MATERIALIZED (SELECT c.cluster, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN (
                SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS e FROM (
                  SELECT cluster, i, sum(e[i])::BIGINT AS s, count(*) AS n FROM n{i} JOIN v USING (vec_id), range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1) m USING (cluster))"""
    steps = ",\n".join(near.format(i=i) + ",\n" + mean.format(i=i, j=i + 1) for i in range(rounds))
    return f"""
        WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
                   WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS cluster, e FROM v ORDER BY cluster LIMIT {k}),
             {steps},
             {near.format(i=rounds)}
        SELECT vec_id, cluster::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(e, ',')) AS centroid_sha256
        FROM n{rounds} JOIN c{rounds} USING (cluster)"""


def op13_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector; rows as capfilters.near_duplicates() has them."""
    return capfilters.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_token_files, op3_multiset_hash, op4_warc, op5_secrets, op6_sentencepiece, op7_quality, op8_mixing, op9_top_k, op10_line_dedup, op11_importance, op12_centroids, op13_cap_filters)
}

ORACLE_SQL: dict[str, str] = {
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS last FROM p),
             b AS (SELECT *, list_reduce(list_transform(range(0, 32), lambda i:
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)]), lambda x, y: x || y) AS digest FROM d)
        SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
               CASE WHEN last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN last <> page_id THEN last END AS refers_to
        FROM b""",
    "op9_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
                   FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_importance": r"""
        WITH ws AS (SELECT 's' AS side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
                    UNION ALL SELECT 't', NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
             f AS MATERIALIZED (SELECT side, doc_id, unnest(w) AS word FROM ws),
             crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) AS c FROM range(256) r(i))),
             hexed AS (SELECT word, hex(encode(word)) AS hx FROM (SELECT DISTINCT word FROM f)),
             b AS MATERIALIZED (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(hx) // 2), lambda i: ('0x' || substr(hx, 1 + 2 * i, 2))::BIGINT)),
                        lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)])), 4294967295) % 10000 AS bucket FROM hexed, crc),
             n AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM f JOIN b USING (word) GROUP BY 1),
             g AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (SELECT sum(s) + 10000 FROM n)) / ((s + 1)::DOUBLE * (SELECT sum(t) + 10000 FROM n))))::BIGINT AS gain FROM n),
             sums AS (SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS gain FROM f JOIN b USING (word) JOIN g USING (bucket) WHERE side = 's' GROUP BY 1),
             w AS (SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce((gain - ((gain % n_features) + n_features) % n_features) // n_features, 0) AS weight,
                          ('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT AS h FROM documents d LEFT JOIN sums USING (doc_id)),
             sc AS (SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296::DOUBLE))))::BIGINT AS score FROM w),
             r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, (10 * count(*) OVER (PARTITION BY n_features >= 20)) // 100 AS most FROM sc)
        SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score, CASE WHEN n_features >= 20 AND place <= most THEN place END AS rank FROM r""",
    "op12_centroids": lloyd_sql(),
}
