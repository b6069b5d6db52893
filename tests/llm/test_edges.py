"""Every operator and stage on null and repeated ids, null, empty and long texts, odd ids, clashing names, empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from examlake.llm import huffman, linededup, mixing, multiset_hash, nearcopies, pieces, quality, queries, secret_scan, simhash, topk, warc
from examlake.llm.queries import tokenizer_path

NAMES = ("ranges", "quality_score", "runs_", "removed", "id", "h", "fp", "key", "pass", "size", "block", "words", "component", "score", "before", "part")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
LONG = " ".join(f"word{i % 7919}" for i in range(60_000))
ROWS = [(1, "one two three"), (1, "one two three"), (1, "another text of the same id"), (1, None), (2, None), (3, ""), (4, " \n "), (-(2**63), "least id"), (2**63 - 1, "greatest id"), (5, LONG), (6, LONG + " end"), (7, "x" * 100_000), (8, "tie tie tie"), (9, "tie tie tie"), (None, "no id"), (None, None)]
IDS = {i for i, _ in ROWS if i is not None}
PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", None if k % 3 == 0 else f"s{k % 2}", len(t or ""), *["clash"] * len(NAMES)) for k, (i, t) in enumerate(ROWS)], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (1, 1, 1), (None, 1, 0), (5, None, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")


def pages(docs):
    return docs.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://x/\n"), "lang").alias("url"), F.col("text").alias("html"), *NAMES)


#: Each gives the column of ids, and whether rows without an id and rows that repeat one are in its result.
OPERATORS = {
    "simhash": (lambda d, la: simhash.near_duplicates(d), "id", True, True),
    "token files": (lambda d, la: huffman.round_trip(d, tokenizer_path(WORDS)), "doc_id", False, True),
    "multiset hash": (lambda d, la: multiset_hash.compared(d), "doc_id", False, True),
    "warc": (lambda d, la: warc.round_trip(pages(d)), "page_id", False, True),
    "secrets": (lambda d, la: secret_scan.digest(d), "doc_id", True, True),
    "pieces": (lambda d, la: pieces.digest(d, tokenizer_path(PIECES)), "doc_id", False, True),
    "quality": (lambda d, la: quality.classified(d, la), "doc_id", True, True),
    "mixing": (lambda d, la: mixing.Plan(d).taken(), "doc_id", True, False),
    "line dedup": (lambda d, la: linededup.deduplicated(d), "doc_id", True, True),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(docs, labels, name):
    run, key, without, repeated = OPERATORS[name]
    rows = run(docs, labels).collect()
    assert {r[key] for r in rows} - {None} == IDS
    if repeated:
        assert len(rows) == len(ROWS) if without else len(rows) == len([i for i, _ in ROWS if i is not None])
    assert run(docs.limit(0), labels.limit(0)).count() == 0


def test_top_k(spark):
    rows = [(0, [1.0, 2.0]), (0, [3.0, 1.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0]), (100, []), (200, None), (None, [1.0, 1.0]), (300, [1e30, 1e30]), (-(2**63), [1.0, 2.0])]
    got = topk.top_k(spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, dim string, block int"), k=2).collect()
    assert {r["query_id"] for r in got} == {0, 300} and all(r["vec_id"] != r["query_id"] for r in got)
    assert [(r["rank"], r["vec_id"]) for r in sorted(got) if r["query_id"] == 300] and topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage(spark, docs, labels, tmp_path, name):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, str(tmp_path))
    rows = out.collect()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns and all(r[n] == "clash" for r in rows for n in NAMES)
        assert all(r["n_chars"] == len(r["text"] or "") for r in rows if r["text"] is not None or not r["n_chars"])
    assert {r["doc_id"] for r in rows} <= IDS | {None}
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_mixed_rows_keep_to_their_own_words(spark, docs):
    own = {}
    for i, t in ROWS:
        own.setdefault(i, []).extend((t or "").split())
    for r in mixing.mix(docs).collect():
        assert r["doc_id"] is not None and set(r["text"].split()) <= set(own[r["doc_id"]])
    sizes = {(r["doc_id"], r["source_size"]): r["taken"] for r in mixing.Plan(docs).taken().collect() if r["doc_id"] is not None}
    assert sum(sizes.values()) == sum(len(r["text"].split()) for r in mixing.mix(docs).collect())


def test_warc_shards_of_sparse_ids(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 5000)
    rows = [(i, "http://x", "p" * 600 + str(i)) for i in range(60)] + [(2**40, "u", "far"), (-(2**63), "u", "least"), (2**63 - 1, "u", "greatest")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = df.select("page_id", warc.shard_column(df.withColumn("payload", F.col("html").cast("binary"))).alias("s")).orderBy("page_id").collect()
    shards = [r["s"] for r in got]
    assert shards == sorted(shards) and 10 <= len(set(shards)) <= 16
    assert sorted(r["page_id"] for r in warc.round_trip(df).collect()) == sorted(i for i, _, _ in rows)


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i % 10, f"text {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 10, i % 2) for i in range(40)], "doc_id long, quality int")
    assert quality.classified(docs, labels).count() == 60


def test_queries_have_docstrings_for_their_rows():
    assert all(q.__doc__ for q in queries.QUERIES.values())


def test_near_copies(docs):
    rows = nearcopies.near_duplicates(docs).collect()
    assert {r["id"] for r in rows} == IDS
