"""SentencePiece encoding and decoding over a relational lattice.

Words' substrings are exploded, joined to the piece table on the substring, grouped again by word, and folded with a
higher-order aggregate: Viterbi for unigram models, and for BPE models, whose scores are merge ranks and not
log-probabilities, the merges in order of score. Both give the ids of the library for the model's own type.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from examlake.llm.common import let, partitions, scratch, slices

SPACE = "▁"
#: Words are cut so that no piece reaches over a border. One longer than LONGEST is cut again at every such place; what
#: is still longer (a run in which pieces overlap everywhere) has more borders than the bits of a long can hold, and
#: goes to the library.
LONGEST = 60
#: Characters of text that share a table of words, and partitions of input whose blocks are folded together.
BLOCK, SLICE = 1 << 23, 512


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[tuple[str, int, float], ...]  # piece, id, score; normal pieces only
    bpe: bool
    byte_ids: tuple[int, ...]
    unknown: int
    raw: tuple[bytes, ...]  # what each id decodes to, spaces as SPACE
    longest: int
    late: frozenset[str]  # pieces that a merge of lower score can make possible
    unit: re.Pattern  # a text's words


def words_of(pieces: list[str]) -> re.Pattern:
    """A pattern for words, between which no piece reaches: spaces and the letters or the other characters that follow.

    Characters of no longer piece stand alone. The two classes have no neighbours in any piece: from letters and the
    rest, characters are moved over until this is so.
    """
    pairs = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)} - {SPACE * 2}
    inside = {c for p in pairs for c in p} - {SPACE}
    letters = {c for c in inside if c.isalpha()}
    while moved := {c for p in pairs if not letters.isdisjoint(p) for c in p} - letters - {SPACE}:
        letters |= moved
    classes = ["[" + "".join(map(re.escape, sorted(c))) + "]+" for c in (letters, inside - letters) if c]
    return re.compile(f"{SPACE}*(?:{'|'.join(classes)})|{SPACE}+|[^{SPACE}]" if classes else f"{SPACE}+|[^{SPACE}]")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    if m.normalizer_spec.precompiled_charsmap or m.normalizer_spec.remove_extra_whitespaces or not m.normalizer_spec.add_dummy_prefix:
        raise ValueError("only models with identity normalisation and a dummy prefix are supported")
    normal = tuple((p.piece, i, p.score) for i, p in enumerate(m.pieces) if p.type == 1)
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _, _ in normal):
        raise ValueError("pieces reach across words")
    by_byte = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == 6}
    raw = tuple(bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.encode() if p.type == 1 else b"" for p in m.pieces)
    rank = {p: s for p, _, s in normal if len(p) > 1}
    parts = lambda p: ((p[:i], p[i:]) for i in range(1, len(p)))
    made = lambda a: len(a) == 1 or a in rank
    late = frozenset(p for p, s in rank.items() if any(made(a) and made(b) and min(rank.get(a, s), rank.get(b, s)) < s for a, b in parts(p)))
    return Vocabulary(normal, m.trainer_spec.model_type == 2, tuple(by_byte[i] for i in range(256)) if by_byte else (), next((i for i, p in enumerate(m.pieces) if p.type == 2), 0), raw, max(len(p) for p, _, _ in normal), late, words_of([*rank]))


@lru_cache(maxsize=2)
def library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_table(spark: SparkSession, v: Vocabulary) -> DataFrame:
    """(piece, piece_id, score, late): as long as the vocabulary."""
    piece, number, score = zip(*v.pieces, strict=True) if v.pieces else ((), (), ())
    columns = {"piece": pa.array(piece, pa.string()), "piece_id": pa.array(number, pa.int32()), "score": pa.array(score, pa.float64()), "late": pa.array([p in v.late for p in piece], pa.bool_())}
    return spark.createDataFrame(pa.table(columns))  # from Arrow: rows would be made in Python workers of their own, which stay


def lattice(words: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """(cell, word, edges): the pieces that occur in each word as array<struct<start, len, piece_id, score, mask, ends, late>>,
    and single characters without a piece (piece_id -1). Words have LONGEST characters at most.

    Substrings no longer than the longest piece, equi-joined to the piece table, which is small by its vocabulary and
    broadcast; words are already dealt by cell, so grouping needs no further exchange, and sorts by the hash first.
    """
    n = F.length("word")
    start = words.select("cell", "hash", "word", F.explode(F.sequence(F.lit(1), n)).alias("start"))
    both = start.select("cell", "hash", "word", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), n - F.col("start") + 1))).alias("len"))
    # As bits: mask has all borders from the start to the end of an edge, ends these two alone (a word has up to 60 characters).
    edges = both.withColumn("piece", F.substring("word", F.col("start"), F.col("len"))).join(F.broadcast(table), "piece", "left").where("piece_id is not null or len = 1")
    bits = edges.withColumn("ends", F.expr("shiftleft(1L, start) | shiftleft(1L, start + len)")).withColumn("mask", F.expr("shiftleft(1L, start + len + 1) - shiftleft(1L, start)"))
    return bits.groupBy("cell", "hash", "word").agg(F.collect_list(F.struct("start", "len", F.coalesce("piece_id", F.lit(-1)).alias("piece_id"), "score", "mask", "ends", "late")).alias("edges"))


def viterbi(word: Column, edges: Column) -> Column:
    """array<struct<start, len, piece_id>> of the path with the highest sum of scores; a character without a piece
    is an edge of its own (piece_id -1) far below all others. Ties go to the longer last piece."""
    best_type = "array<struct<total:double,start:int,len:int,piece_id:int>>"
    first = F.array(F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("start"), F.lit(0).alias("len"), F.lit(-1).alias("piece_id"))).cast(best_type)

    def step(best: Column, end: Column) -> Column:  # best[k]: the best way to the end of the k-th character
        into = F.filter(edges, lambda e: (e["start"] + e["len"] - 1 == end) & (e["piece_id"] >= 0))
        known = F.transform(into, lambda e: F.struct((F.get(best, e["start"] - 1)["total"] + e["score"]).alias("total"), e["len"].alias("by"), e["start"].alias("start"), e["len"].alias("len"), e["piece_id"].alias("piece_id")))
        lone = F.array(F.struct((F.get(best, end - 1)["total"] - 1e6).alias("total"), F.lit(0).alias("by"), end.alias("start"), F.lit(1).alias("len"), F.lit(-1).alias("piece_id")))
        top = F.array_max(F.concat(known, lone))
        return let(top, lambda t: F.concat(best, F.array(F.struct(t["total"].alias("total"), t["start"].alias("start"), t["len"].alias("len"), t["piece_id"].alias("piece_id")))))

    best = F.aggregate(F.sequence(F.lit(1), F.length(word)), first, lambda b, end: step(b, end).cast(best_type))
    none = F.array().cast("array<struct<start:int,len:int,piece_id:int>>")

    def back(best: Column) -> Column:
        ends = F.sequence(F.length(word), F.lit(1), F.lit(-1))
        grow = lambda s, e: F.when(s["at"] != e, s).otherwise(let(F.get(best, e), lambda t: F.struct((t["start"] - 1).alias("at"), F.concat(F.array(F.struct(t["start"].alias("start"), t["len"].alias("len"), t["piece_id"].alias("piece_id"))), s["path"]).alias("path"))))
        return F.aggregate(ends, F.struct(F.length(word).alias("at"), none.alias("path")), grow, lambda s: s["path"])

    return let(best, back)


def merged(word: Column, edges: Column) -> Column:
    """array<struct<start, len, piece_id>> of BPE: while two neighbours make a piece, the pair of highest score (the
    leftmost on ties) becomes one. The fold's state is the set of borders as the bits of a long: an edge joins two
    neighbours if its ends and one border between them are set, and is a segment if only its ends are.

    One fold over the edges in order of score does these merges, unless one of them lets an edge of higher score fit
    that did not before. Only the vocabulary's late pieces can; a word where that happens is folded merge by merge.
    """
    longer = F.filter(edges, lambda e: e["len"] > 1)
    start = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(word) + 2) - 2
    fits = lambda cuts, e: (cuts.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(cuts.bitwiseAND(e["mask"])) == 3)
    without = lambda cuts, e: cuts.bitwiseAND(F.bitwise_not(e["mask"].bitwiseXOR(e["ends"])))

    def slow(wide: Column) -> Column:
        def step(cuts: Column) -> Column:
            ranked = F.transform(F.filter(wide, lambda e: fits(cuts, e)), lambda e: F.struct(e["score"].alias("score"), (-e["start"]).alias("left"), e["mask"].alias("mask"), e["ends"].alias("ends")))
            return let(F.array_max(ranked), lambda top: F.when(top.isNull(), cuts).otherwise(without(cuts, top)))

        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(word) - 1, F.lit(1))), start, lambda cuts, i: step(cuts))

    def quick(wide: Column) -> Column:  # the borders; null once an edge that was passed over fits
        ordered = F.sort_array(F.transform(wide, lambda e: F.struct((-e["score"]).alias("order"), e["start"].alias("start"), e["mask"].alias("mask"), e["ends"].alias("ends"))))
        late = F.filter(wide, lambda e: e["late"])

        def step(cuts: Column, e: Column, late: Column) -> Column:
            missed = lambda now: F.exists(late, lambda p: (-p["score"] < e["order"]) & fits(now, p))
            return F.when(~fits(cuts, e), cuts).otherwise(let(without(cuts, e), lambda now: F.when(~missed(now), now)))

        return let(late, lambda known: F.aggregate(ordered, start, lambda cuts, e: step(cuts, e, known)))

    done = let(longer, lambda wide: let(quick(wide), lambda cuts: F.when(cuts.isNotNull(), cuts).otherwise(slow(wide))))

    def named(cuts: Column) -> Column:
        segments = F.filter(edges, lambda e: cuts.bitwiseAND(e["mask"]) == e["ends"])
        return F.sort_array(F.transform(segments, lambda e: F.struct(e["start"].alias("start"), e["len"].alias("len"), e["piece_id"].alias("piece_id"))))

    return let(done, named)


def word_ids(words: DataFrame, path: str) -> DataFrame:
    """(cell, word, ids) for distinct words (cell, hash, word); characters without a piece become their bytes, or the unknown id."""
    v = vocabulary(path)
    folded = lattice(words, piece_table(words.sparkSession, v), v.longest)
    path_ = (merged if v.bpe else viterbi)(F.col("word"), F.col("edges"))
    bytes_of = F.array(*map(F.lit, v.byte_ids)) if v.byte_ids else None

    def ids(s: Column) -> Column:
        if bytes_of is None:
            return F.array(F.when(s["piece_id"] >= 0, s["piece_id"]).otherwise(v.unknown))
        code = F.hex(F.encode(F.substring(F.col("word"), s["start"], F.lit(1)), "UTF-8"))
        lone = F.transform(F.sequence(F.lit(0), (F.length(code) / 2).cast("int") - 1), lambda i: F.get(bytes_of, F.conv(F.substring(code, 2 * i + 1, F.lit(2)), 16, 10).cast("int")))
        return F.when(s["piece_id"] >= 0, F.array(s["piece_id"])).otherwise(lone)

    return folded.select("cell", "word", path_.alias("segments")).select("cell", "word", F.flatten(F.transform("segments", ids)).alias("ids"))


def parts(word: str, pieces: frozenset[str], longest: int) -> Iterator[str]:
    """The word's parts between borders that no piece reaches over."""
    at = reach = 0
    for i in range(len(word)):
        if i >= reach and i > at:
            yield word[at:i]
            at = i
        reach = max([reach, *(i + n for n in range(2, longest + 1) if word[i : i + n] in pieces)])
    yield word[at:]


class Codes(dict):
    """Numbers words in the order in which they are met."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of integers, their bytes sorted by place and compressed."""
    planes = [a.astype(t := a.dtype.newbyteorder("<")).view(np.uint8).reshape(-1, t.itemsize).T.tobytes() for a in arrays]
    head = np.array([x for a in arrays for x in (a.dtype.itemsize, len(a))], "<i8").tobytes()
    return np.int64(len(arrays)).tobytes() + head + zstandard.compress(b"".join(planes), 3)


def unpacked(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    head, rest, at, out = np.frombuffer(data, "<i8", 2 * n, 8).reshape(-1, 2).tolist(), zstandard.decompress(data[8 + 16 * n :]), 0, []
    for width, size in head:
        planes = np.frombuffer(rest, np.uint8, width * size, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"<i{width}"))
        at += width * size
    return out


def tables(docs: DataFrame, path: str, buckets: int) -> DataFrame:
    """Rows of two kinds for each block of documents: its distinct words, those of one bucket (by CRC-32) joined by
    blanks in one row (block, cell, bucket, words), where a cell is a bucket of SLICE partitions; and one row (block,
    docs) with the documents: row keys, and texts as codes, which count the block's words by bucket.

    Words beyond LONGEST have codes after these; compound lists what each is made of: codes, or ids (as -1 - id).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, v = TaskContext.get().partitionId(), vocabulary(path)
        whole = frozenset(p for p, _, _ in v.pieces if len(p) > 1)
        schema = pa.schema([("block", pa.int64()), ("cell", pa.int64()), ("bucket", pa.int32()), ("words", pa.string()), ("docs", pa.binary())])
        block, codes, texts, keys, size = task << 32, Codes(), [], [], 0

        def ended() -> Iterator[pa.RecordBatch]:
            long = [w for w in codes if len(w) > LONGEST]
            made = [[codes[p] if len(p) <= LONGEST else tuple(library(path).encode("\n" + p.replace(SPACE, " "))[2:]) for p in parts(w, whole, v.longest)] for w in long]
            words = [w for w in codes if len(w) <= LONGEST]
            bucket = np.array([zlib.crc32(w.encode()) % buckets for w in words], np.int32)
            order = np.argsort(bucket, kind="stable")
            rank = np.zeros(len(codes), np.int64)
            rank[np.fromiter((codes[words[i]] for i in order), np.int64, len(words))] = np.arange(len(words))
            rank[[codes[w] for w in long]] = len(words) + np.arange(len(long))
            compound = [[y for x in m for y in ([int(rank[x])] if isinstance(x, int) else [-1 - i for i in x])] for m in made]
            blob = packed(np.array(keys, np.int64), np.array([*map(len, texts)], np.int32), rank[np.concatenate(texts)].astype(np.int32), np.array([*map(len, compound)], np.int32), np.array([*chain.from_iterable(compound)], np.int32))
            starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            rows = [" ".join([words[i] for i in o]) for o in np.split(order, starts[1:])] if len(words) else []
            there, n = bucket[order][starts], len(rows)
            for i in range(0, n, 256):
                k = len(rows[i : i + 256])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, block)), pa.array((task // SLICE) * buckets + there[i : i + k].astype(np.int64)), pa.array(there[i : i + k]), pa.array(rows[i : i + k], pa.string()), pa.nulls(k, pa.binary())], schema=schema)
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.string()), pa.array([blob])], schema=schema)

        for b in slices(batches):
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = text.as_py()
                if size and size + len(t) > BLOCK:
                    yield from ended()
                    block, codes, texts, keys, size = block + 1, Codes(), [], [], 0
                keys.append(key)
                units = v.unit.findall(SPACE + t.replace(" ", SPACE)) if t else []
                texts.append(np.fromiter(map(codes.__getitem__, units), np.uint32, len(units)))
                size += len(t)
        if keys:
            yield from ended()

    return docs.mapInArrow(run, "block long, cell long, bucket int, words string, docs binary")


def by_block(df: DataFrame, n: int) -> DataFrame:
    """df written to the shared folder in n buckets by block, so that a join by block need not shuffle it again."""
    name = f"blocks_{uuid.uuid4().hex}"
    df.write.bucketBy(n, "block").option("compression", "zstd").option("path", scratch(df.sparkSession, "blocks")).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def assembled(docs: DataFrame, path: str, emit: Callable, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """emit(keys, offsets, ids) of some documents each time, as record batches.

    Words are folded once for each slice of the corpus, and what travels are words, not texts: blocks send their words,
    a bucket of words in a row, to cells; there distinct words are folded; and ids go back, by block, to the documents,
    which stay where they were written.
    """
    spark = docs.sparkSession
    tasks = 4 * partitions(spark)
    flat = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    both = by_block(tables(flat, path, 4 * tasks), tasks)
    # At most SLICE partitions' blocks, each with the words of one bucket. Both uses of cells share one exchange.
    cells = both.where("docs is null").select("cell", "block", "bucket", "words").repartition(tasks, "cell").groupBy("cell").agg(F.collect_list(F.struct("block", "bucket", "words")).alias("blocks"))
    each = cells.select("cell", F.explode("blocks.words").alias("words")).select("cell", F.explode(F.split("words", " ")).alias("word"))
    distinct = each.select("cell", F.xxhash64("word").alias("hash"), "word").distinct()
    known = word_ids(distinct, path).groupBy("cell").agg(F.collect_list(F.struct("word", "ids")).alias("known"))
    wide = np.uint16 if len(vocabulary(path).raw) <= 1 << 16 else np.uint32

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blocks, entries in zip(b.column(0), b.column(1), strict=True):
                words, lists = entries.values.field("word").to_pylist(), entries.values.field("ids")
                sizes, pool = lists.value_lengths().to_numpy(), lists.flatten().to_numpy().astype(wide)
                at, code = np.cumsum(sizes) - sizes, dict(zip(words, range(len(words)), strict=True))
                table, out = blocks.values, []
                for w in table.field("words").to_pylist():
                    found = np.fromiter(map(code.__getitem__, w.split(" ")), np.int64)
                    out.append(packed(sizes[found].astype(np.uint8), pool[gathered(at[found], sizes[found])]))
                yield pa.RecordBatch.from_arrays([table.field("block"), table.field("bucket"), pa.array(out, pa.binary())], names=["block", "bucket", "ids"])

    back = cells.join(known, "cell").select("blocks", "known").mapInArrow(named, "block long, bucket int, ids binary")
    # A block has a row for each bucket of its words, so as much as it has words.
    words = back.repartition(tasks, "block").groupBy("block").agg(F.collect_list(F.struct("bucket", "ids")).alias("words"))
    whole = both.where("docs is not null").select("block", "docs").join(words, "block", "left").select("docs", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                keys, sizes, codes, lengths, compound = unpacked(b.column(0)[k].as_py())
                at, size, pool = dictionary(b.column(1)[k], lengths, compound, wide)
                ends = np.cumsum(sizes, dtype=np.int64)
                for i in range(0, len(keys), 256):
                    some = codes[ends[i] - sizes[i] : ends[min(i + 256, len(keys)) - 1]]
                    stop = np.concatenate([[0], np.cumsum(size[some])])
                    cuts = stop[np.concatenate([[0], np.cumsum(sizes[i : i + 256])])]
                    yield emit(keys[i : i + 256], cuts, pool[gathered(at[some], size[some])])

    return whole.mapInArrow(run, schema)


def gathered(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indexes at .. at + size of each entry, one after another."""
    stop = np.cumsum(size, dtype=np.int64)
    return np.arange(stop[-1] if len(stop) else 0) + np.repeat(at - (stop - size), size)


def dictionary(words: pa.Scalar, lengths: np.ndarray, compound: np.ndarray, wide: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where in a pool the ids of each code begin, how many they are, and the pool."""
    rows = sorted(zip(words.values.field("bucket").to_pylist(), words.values.field("ids").to_pylist(), strict=True)) if words.is_valid else []
    both = [unpacked(x) for _, x in rows]
    size = np.concatenate([np.zeros(0, np.int64), *(s.view(np.uint8).astype(np.int64) for s, _ in both)])
    pool = np.concatenate([np.zeros(0, np.int32), *(p.view(np.dtype(wide)).astype(np.int32) for _, p in both)])
    at = np.cumsum(size) - size
    for part in np.split(compound, np.cumsum(lengths))[:-1]:
        ids = np.concatenate([pool[at[x] : at[x] + size[x]] if x >= 0 else [-1 - x] for x in part.tolist()]).astype(np.int32)
        at, size, pool = np.append(at, len(pool)), np.append(size, len(ids)), np.concatenate([pool, ids])
    return at, size, pool


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) per row of docs: array<int>, as the library encodes the whole text.

    Null and empty texts give no ids; rows that repeat an id stay apart; rows without an id are left out; extra columns
    are ignored, whatever their names; an empty table gives an empty one.
    """
    emit = lambda keys, cuts, ids: pa.RecordBatch.from_arrays([pa.array(keys), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))], names=["id", "ids"])
    return assembled(docs, path, emit, "id long, ids array<int>", id_col, text_col)


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """(id, text) from (id, ids): pieces and bytes joined, the dummy prefix taken off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = vocabulary(path).raw
        for b in batches:
            texts = [b"".join(map(raw.__getitem__, x)).decode("utf-8", "replace").replace(SPACE, " ")[1:] for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return ids.select("id", "ids").mapInArrow(run, "id long, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Per document from its ids: how many, their CRC-32 as little-endian 32-bit integers, and the decoded text's
    length in code points and CRC-32. Rows as encoded() has them."""

    def emit(keys: np.ndarray, cuts: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        raw, all_, at = vocabulary(path).raw, ids.tolist(), cuts.tolist()
        texts = [b"".join(map(raw.__getitem__, all_[a:z])).decode("utf-8", "replace").replace(SPACE, " ")[1:] for a, z in pairwise(at)]
        data = ids.astype("<u4")
        sums = [zlib.crc32(data[a:z].tobytes()) for a, z in pairwise(at)]
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.diff(cuts)), pa.array(sums, pa.int64()), pa.array([*map(len, texts)], pa.int64()), pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64())], names=["doc_id", "n_pieces", "ids_crc32", "n_chars", "text_crc32"])

    return assembled(docs, path, emit, "doc_id long, n_pieces long, ids_crc32 long, n_chars long, text_crc32 long")
