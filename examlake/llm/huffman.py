"""Token-id files: canonical length-limited Huffman coding, in independent blocks with bit-offset checkpoints."""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examlake.llm.common import partitions, scratch, slices, stored

#: Longest code in bits, while the symbols fit (longest_code); the decoding table has 2^LIMIT entries.
LIMIT = 16
#: Ids in a block (a block closes with the document that reaches it), and ids between two checkpoints.
BLOCK_IDS, EVERY = 1 << 18, 128

# ---------------------------------------------------------------- tokenizing

#: Texts of these characters only: lower-casing and cutting at blanks and where other marks follow a letter commute
#: with the tokenizer.
PLAIN = r"^[\t-\r -&(-~À-ÖØ-öø-ÿ]*$"
STOP = r"([a-zß-öø-ÿ])([^a-zß-öø-ÿ0-9\s]+)"
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the others in
    order from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


#: Chunks remembered by one worker; beyond it the memory starts anew.
REMEMBERED = 700_000


class Encoder:
    """Encodes texts with a tokenizer file; equal chunks are encoded once.

    The word_bpe tokenizer cuts texts at blanks and where letters meet other characters, after lower-casing. For
    PLAIN texts without special tokens its ids are thus those of the chunks in order; any other text goes whole to
    the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.largest = max(self.tok.get_vocab().values(), default=0)
        known = self.tok.to_str(pretty=False)
        self.by_words = all(part in known for part in ('"end_of_word_suffix":"</w>"', '"type":"Lowercase"', '"type":"ByteLevel"'))
        self.letters = byte_letters()
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.pool, self.used = np.zeros(1 << 20, np.uint32), 0
        self.at, self.size = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, chunks: list[str], ids: list[list[int]]) -> None:
        k, n = len(self.code), len(chunks)
        sizes = np.fromiter(map(len, ids), np.int64, n)
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        while k + n > len(self.at):
            self.at, self.size = np.resize(self.at, 2 * len(self.at)), np.resize(self.size, 2 * len(self.at))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.at[k : k + n], self.size[k : k + n] = self.used + np.cumsum(sizes) - sizes, sizes
        self.pool[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.code.update(zip(chunks, range(k, k + n), strict=True))

    def _codes(self, chunks: list[str]) -> np.ndarray:
        new = [c for c in chunks if c not in self.code]
        model = self.tok.model
        # The model takes a run of letters by their bytes; the library cuts any other chunk first.
        as_bytes = lambda c: c if c.isascii() else c.encode().decode("latin-1").translate(self.letters)
        self._learn(new, [[t.id for t in model.tokenize(as_bytes(c))] if c.isalpha() else self._ids(c).tolist() for c in new])
        return np.fromiter(map(self.code.__getitem__, chunks), np.int64, len(chunks))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.code) > REMEMBERED:
            self.forget()
        plain = pc.and_(pc.match_substring_regex(texts, PLAIN), pc.invert(pc.match_substring(texts, "<|")))
        plain = plain.to_numpy(zero_copy_only=False) & self.by_words
        easy = texts.filter(pa.array(plain))
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(easy), STOP, r"\1 \2"))
        coded = lists.flatten().dictionary_encode()
        codes = self._codes(coded.dictionary.to_pylist())[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        cuts = lists.offsets.to_numpy()
        done = iter(self.pool[spans(self.at[c], self.size[c])] for c in (codes[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)))
        return [next(done) if p else self._ids(x.as_py()) for p, x in zip(plain, texts, strict=True)]


def width(tokenizer_file: str, end_id: int | None = None) -> str:
    """The integers that hold ids on their way to the files: 16 bits where the vocabulary allows."""
    largest = max([encoder(tokenizer_file).largest, *([] if end_id is None else [end_id])])
    return "<u2" if largest <= 0xFFFF else "<u4"


def spans(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices at[0].. at[0]+size[0]-1, at[1].. and so on."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(at - (ends - size), size)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_ids(docs: DataFrame, tokenizer_file: str, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) per document: ids as little-endian unsigned integers of width(); null texts count as empty."""
    kind = width(tokenizer_file, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([] if end_id is None else [end_id], np.uint32)
        for b in slices(batches, 2048):
            ids = encoder(tokenizer_file).encode(pc.fill_null(b.column(1), ""))
            blobs = [np.concatenate([x, end]).astype(kind).tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(blobs, pa.binary())], names=["id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, ids binary")


# ---------------------------------------------------------------- code


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code length of each symbol, at most limit; 0 where the count is 0. Ties go to the smaller symbol.

    Huffman's lengths, and where these exceed the limit the optimal ones under it, by package-merge.
    """
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols don't fit codes of {limit} bits")
    if len(used) < 2:
        out[used] = 1
        return out
    order = used[np.lexsort((used, counts[used]))]
    weights = counts[order].astype(np.float64).tolist()
    heap = [(w, i) for i, w in enumerate(weights)]
    parent = [0] * (2 * len(order) - 1)
    for node in range(len(order), 2 * len(order) - 1):
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        parent[a[1]] = parent[b[1]] = node
        heapq.heappush(heap, (a[0] + b[0], node))
    depth = [0] * len(parent)
    for node in range(len(parent) - 2, -1, -1):
        depth[node] = depth[parent[node]] + 1
    lengths = np.array(depth[: len(order)])
    if lengths.max() > limit:
        leaves = np.array(weights)
        merged, rounds = leaves, []
        for _ in range(limit - 1):  # each round: packages of two from the last, merged with the leaves
            pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
            both = np.concatenate([leaves, pairs])
            rank = np.argsort(both, kind="stable")
            rounds.append(rank < len(leaves))
            merged = both[rank]
        lengths, take = np.zeros(len(order), np.int64), 2 * len(order) - 2
        for is_leaf in reversed(rounds):  # the cheapest items; the leaves among them each get one bit more
            n = int(is_leaf[:take].sum())
            lengths[:n] += 1
            take = 2 * (take - n)
        lengths[:take] += 1
    out[order] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol: counting upwards by length, then symbol."""
    codes, code, last = np.zeros(len(lengths), np.uint32), 0, 0
    order = np.flatnonzero(lengths)
    order = order[np.lexsort((order, lengths[order]))]
    for n in np.unique(lengths[order]):
        same = order[lengths[order] == n]
        code <<= int(n) - last
        codes[same] = code + np.arange(len(same))
        code, last = code + len(same), int(n)
    return codes


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, every: int = EVERY) -> tuple[bytes, np.ndarray]:
    """The block's bytes (codes one after the other, high bits first) and the bit offset of each every-th id."""
    size = lengths[ids].astype(np.int64)
    if (size == 0).any():
        raise ValueError("an id has no code")
    ends = np.cumsum(size)
    at = ends - size
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 32 + 3, np.uint64)
    shifted = codes[ids].astype(np.uint64) << (64 - size - (at & 31)).astype(np.uint64)  # a code spans two 32-bit words at most
    word = at >> 5
    first = np.flatnonzero(np.diff(word, prepend=-1))
    if len(first):
        joined = np.bitwise_or.reduceat(shifted, first)
        words[word[first]] |= joined >> np.uint64(32)
        words[word[first] + 1] |= joined & np.uint64(0xFFFFFFFF)
    return words.astype(">u4").tobytes()[: (total + 7) // 8], at[::every].astype(np.uint32)


def decode_table(lengths: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """For each next limit bits: symbol << 8 | length; 0 where no code begins so."""
    table = np.zeros(1 << limit, np.uint32)
    order = np.flatnonzero(lengths)
    order = order[np.lexsort((order, lengths[order]))]
    entries = np.repeat((order.astype(np.uint32) << 8) | lengths[order], 1 << (limit - lengths[order].astype(np.int64)))
    table[: len(entries)] = entries
    return table


def decode_block(data: bytes, n: int, marks: np.ndarray, table: np.ndarray, every: int = EVERY, limit: int = LIMIT) -> np.ndarray:
    """The n ids of a block: all its checkpoints are read side by side, one id of each in a step."""
    raw = np.frombuffer(data + b"\0" * 8, np.uint8).astype(np.uint32)
    window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    at = marks.astype(np.int64)
    out = np.empty((every, len(at)), np.uint32)
    last = len(window) - 1
    for k in range(every):
        found = table[(window[np.minimum(at >> 3, last)] >> (32 - limit - (at & 7)).astype(np.uint32)) & np.uint32((1 << limit) - 1)]
        out[k] = found >> 8
        at = at + (found & 0xFF)
    return out.T.reshape(-1)[:n]


# ---------------------------------------------------------------- files


def symbol_counts(tokens: DataFrame, kind: str) -> np.ndarray:
    """Global counts by id; each task counts into one array, and rows for ids are summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for b in batches:
            for x in b.column(0):
                got = np.bincount(np.frombuffer(x.as_buffer(), kind))
                if len(got) > len(total):
                    total = np.pad(total, (0, len(got) - len(total)))
                total[: len(got)] += got
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["symbol", "n"])

    rows = tokens.select("ids").mapInArrow(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).toPandas()  # one row per id of the vocabulary
    out = np.zeros(int(rows["symbol"].max()) + 1 if len(rows) else 1, np.int64)
    out[rows["symbol"].to_numpy(int)] = rows["n"].to_numpy()
    return out


BLOCKS = "shard int, block int, first_id long, doc_ids binary, doc_sizes binary, n_ids long, marks binary, bits binary"


def longest_code(counts: np.ndarray) -> int:
    """Bits that code_lengths may use: LIMIT, or one more than the symbols need."""
    return max(LIMIT, int(max(0, np.count_nonzero(counts) - 1)).bit_length() + 1) if np.count_nonzero(counts) > 1 << LIMIT else LIMIT


def write(tokens: DataFrame, path: str, block_ids: int = BLOCK_IDS, every: int = EVERY, kind: str = "<u2") -> None:
    """Writes (id, ids) in ascending id order: blocks/ (Parquet, range-sorted shards of blocks) and code/ (lengths).

    A block holds whole documents: their ids and sizes, the coded bits, and the bit offset of every every-th id, so
    that any block is read alone and from any checkpoint. Rows without an id are left out; equal ids stay side by side,
    in the order of their token ids' bytes. kind: the integers in ids.
    """
    spark = tokens.sparkSession
    counts = symbol_counts(tokens, kind)
    limit = longest_code(counts)
    lengths = code_lengths(counts, limit)
    # From Arrow: rows would be made in Python workers of their own, which stay.
    head = pa.table({"lengths": pa.array([lengths.tobytes()], pa.binary()), "every": pa.array([every], pa.int32()), "longest": pa.array([limit], pa.int32())})
    spark.createDataFrame(head).coalesce(1).write.parquet(f"{path}/code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder.cache_clear()  # the worker may have encoded before
        codes, shard, block = canonical(lengths), TaskContext.get().partitionId(), 0
        docs: list[int] = []
        held: list[np.ndarray] = []

        def closed() -> pa.RecordBatch:
            nonlocal block
            ids = np.concatenate(held)
            bits, marks = encode_block(ids, lengths, codes, every)
            row = {"shard": shard, "block": block, "first_id": docs[0], "doc_ids": np.array(docs, "<i8").tobytes(), "doc_sizes": np.array([*map(len, held)], "<i8").tobytes(), "n_ids": len(ids), "marks": marks.astype("<u4").tobytes(), "bits": bits}
            block += 1
            docs.clear()
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("doc_ids", pa.binary()), ("doc_sizes", pa.binary()), ("n_ids", pa.int64()), ("marks", pa.binary()), ("bits", pa.binary())]))

        size = 0
        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                docs.append(i)
                held.append(np.frombuffer(x.as_py(), kind))
                size += len(held[-1])
                if size >= block_ids:
                    yield closed()
                    size = 0
        if docs:
            yield closed()

    tokens.where("id is not null").repartitionByRange(partitions(spark), "id").sortWithinPartitions("id", "ids").mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of written files: (id, start, n_ids, ids); start: the ids of all documents before it.

    One row per written document, also where ids repeat; files of no documents give no rows."""
    head = spark.read.parquet(f"{path}/code").first()
    lengths, every = np.frombuffer(bytes(head["lengths"]), np.uint8), head["every"]
    limit = head["longest"]
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # One row per shard with its total, and one per block: the window over shards is as short as the list of files.
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).selectExpr("shard", "sum(n) over (order by shard) - n as before")
    starts = blocks.join(F.broadcast(shards), "shard").selectExpr("*", "before + sum(n_ids) over (partition by shard order by block) - n_ids as start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()
        table = decode_table(lengths, limit)
        for b in batches:
            for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                ids = decode_block(r["bits"], r["n_ids"], np.frombuffer(r["marks"], "<u4"), table, every, limit)
                sizes = np.frombuffer(r["doc_sizes"], "<i8")
                ends = np.cumsum(sizes)
                blobs = [ids[e - n : e].astype("<u4").tobytes() for e, n in zip(ends, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(r["doc_ids"], "<i8")), pa.array(r["start"] + ends - sizes), pa.array(sizes), pa.array(blobs, pa.binary())], names=["id", "start", "n_ids", "ids"])

    return starts.select("start", "n_ids", "doc_ids", "doc_sizes", "marks", "bits").mapInArrow(run, "id long, start long, n_ids long, ids binary")


def digests(read_back: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each row of read().

    Summed in the JVM: one more Python function above read() would keep twice as many Python workers, each of which then
    holds a tokenizer and its chunks when the next texts are encoded."""
    return read_back.select(F.col("id").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def round_trip(docs: DataFrame, tokenizer_file: str, end_id: int | None = 1) -> DataFrame:
    """Encodes, writes in the shared folder, reads back: (doc_id, start, n_tokens, ids_crc32) from the files.

    Null texts count as empty, an empty table gives empty files and no rows; rows without an id are left out, and rows
    that repeat one follow each other; extra columns are ignored.
    """
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    write(stored(token_ids(docs, tokenizer_file, end_id), "token-ids"), path, kind=width(tokenizer_file, end_id))
    return digests(read(spark, path))
