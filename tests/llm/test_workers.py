"""What keeps Python workers few: each holds a tokenizer or a vocabulary for as long as it lives."""

import zlib

import pyarrow as pa

import corpus_pipeline
from examlake.llm import huffman, mixing, pieces
from examlake.llm.queries import tokenizer_path


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_token_files_are_read_by_one_python_function(spark):
    docs = spark.createDataFrame([(2, "Some words, of a text."), (1, None), (3, "more")], "doc_id long, text string")
    out = huffman.round_trip(docs, tokenizer_path("word_bpe_49k.json"))
    assert _plan(out).count("MapInArrow") == 1
    assert out.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    blobs = [b"", b"\x01\0\0\0", bytes(range(256)) * 5]
    rows = spark.createDataFrame(pa.table({"id": [1, 2, 3], "start": [0, 0, 1], "n_ids": [0, 1, 320], "ids": pa.array(blobs, pa.binary())}))
    assert [r["ids_crc32"] for r in huffman.digests(rows).orderBy("doc_id").collect()] == [*map(zlib.crc32, blobs)]


def test_small_tables_need_no_python_workers(spark):
    v = pieces.vocabulary(tokenizer_path("piece_bpe_32k.model"))
    table = pieces.piece_table(spark, v)
    assert "ExistingRDD" not in _plan(table) and table.dtypes == [("piece", "string"), ("piece_id", "int"), ("score", "double"), ("late", "boolean")]
    assert sorted(map(tuple, table.collect())) == sorted((*p, p[0] in v.late) for p in v.pieces)
    docs = spark.createDataFrame([(1, None, "a b c"), (2, "web", "d " * 200)], "doc_id long, source string, text string")
    for some, n in ((docs, 2), (docs.limit(0), 0)):
        sources = mixing.Plan(some).sources
        assert "ExistingRDD" not in _plan(sources) and sources.count() == n
        assert sources.dtypes == [("source", "string"), ("sid", "int"), ("source_size", "bigint"), ("target", "double"), ("blocks", "bigint"), ("slots", "bigint")]


def test_the_pipeline_bounds_batches_of_long_texts(spark):
    limit = corpus_pipeline.BATCH_BYTES[0]
    before = spark.conf.get(limit)
    try:
        spark.conf.unset(limit)
        corpus_pipeline.prepare(spark)
        docs = spark.range(0, 40, 1, 1).selectExpr("id", "repeat('x', 1000000) as text")
        sizes = [r["n"] for r in docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()]
        assert sum(sizes) > 40_000_000 and max(sizes) < 8_000_000
        spark.conf.set(limit, "9m")
        corpus_pipeline.prepare(spark)
        assert spark.conf.get(limit) == "9m"
    finally:
        spark.conf.set(limit, before)
