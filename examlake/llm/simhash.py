"""SimHash near-dedup by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examlake.llm.common import components, slices, stored

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BLANK = str.maketrans({c: " " for c in "\x09\x0a\x0b\x0c\x0d"})
#: A bucket over this size is split by pieces of the other segment, and a piece over it emits pair keys (2016 masks a
#: member) instead of pairs; below it, pairs are fewer.
PAIRWISE = 64


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def majority(total: np.ndarray, n: int) -> int:
    """The bits that over half of n hashes have, as a signed integer."""
    return int(np.packbits(2 * total > n, bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the text's word shingles as a signed integer; no words give zero.

    Hashes are counted bit by bit in chunks, so memory stays bounded for texts of any length.
    """
    data = (text or "").translate(BLANK).encode("utf-8", "surrogatepass").translate(LOWER)
    words = [w for w in data.split(b" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        h = np.array([digest(line[a:b], seed) for a, b in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)], strict=True)], np.dtype("<u8"))
        total += bit_counts(h)
    return majority(total, n)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row (id, fp long) per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = pa.array([fingerprint(x.as_py(), shingle) for x in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, fp long")


def _variants(fp: Column) -> Column:
    """Two segments of 32 bits; of each, the 32 variants with one bit left open, tagged with segment and bit."""
    out = []
    for segment in (0, 1):
        part = F.shiftrightunsigned(fp, 32 * segment).bitwiseAND(F.lit(0xFFFFFFFF))
        out += [part.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << i))) + F.lit((segment << 37) | (i << 32)) for i in range(32)]
    return F.array(*out)


def _pieces(fp: Column, key: Column) -> Column:
    """Three pieces of the segment that key does not speak of, each tagged with key: two bits leave one of them whole."""
    other = F.when(F.shiftrightunsigned(key, 37) == 0, F.shiftrightunsigned(fp, 32)).otherwise(fp.bitwiseAND(F.lit(0xFFFFFFFF)))
    cuts = [(at, F.shiftrightunsigned(other, at).bitwiseAND(F.lit((1 << wide) - 1))) for at, wide in ((0, 11), (11, 11), (22, 10))]
    return F.array(*[F.struct(key.alias("key"), F.lit(at).alias("at"), value.alias("value")) for at, value in cuts])


def _paired(members: DataFrame, on: list[str]) -> DataFrame:
    """Linked pairs (a, b) of the members fp that agree in on; nothing is broadcast."""
    m = members.select(*on, F.col("fp").alias("a"))
    other = members.select(*on, F.col("fp").alias("b")).hint("merge")
    return m.join(other, on).where("a < b").select("a", "b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)


def links(classes: DataFrame) -> DataFrame:
    """Links (a, b) that join all fingerprints at 2 or fewer differing bits; classes: distinct fp.

    Two bits over two segments leave one segment with one differing bit at most, so linked fingerprints share a
    one-wildcard variant of a segment. Keys with two fingerprints give the pair at once; keys with up to PAIRWISE
    are joined and verified; larger ones are split by three pieces of the other segment, one of which is equal in a
    linked pair. Members of pieces that are larger too go through keys with two open bits, where any two with the same
    key are linked, and each is tied to the least: as many links as members, no pairs, and none is lost. All joins are
    sort-merge joins, as Spark takes exploded keys for as small as what they were made of and would broadcast them.
    """
    keyed = classes.select("fp", F.explode(_variants(F.col("fp"))).alias("key"))
    groups = stored(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "simhash-keys")
    pairs = groups.where("n = 2").select("a", "b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)
    members = stored(keyed.join(groups.where("n > 2").select("key", "n").hint("merge"), "key"), "simhash-members")
    joined = _paired(members.where(F.col("n") <= PAIRWISE), ["key"])
    large = members.where(F.col("n") > PAIRWISE)
    split = stored(large.select("fp", F.explode(_pieces(F.col("fp"), F.col("key"))).alias("p")).select("fp", "p.*"), "simhash-pieces")
    piece = ["key", "at", "value"]
    sizes = stored(split.groupBy(piece).agg(F.count("*").alias("n")).where("n > 1"), "simhash-piece-sizes")
    close = _paired(split.join(sizes.where(F.col("n") <= PAIRWISE).select(piece).hint("merge"), piece), piece)
    many = split.join(sizes.where(F.col("n") > PAIRWISE).select(piece).hint("merge"), piece).select("fp").distinct()
    high = many.select("fp", F.explode(F.sequence(F.lit(1), F.lit(63))).alias("i"))
    both = high.select("fp", "i", F.explode(F.sequence(F.lit(0), F.col("i") - 1)).alias("j"))
    opened = both.selectExpr("fp", "64 * i + j as bits", "fp & ~(shiftleft(1L, i) | shiftleft(1L, j)) as value")
    least = opened.groupBy("bits", "value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    stars = opened.join(least.hint("merge"), ["bits", "value"]).where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.union(joined).union(close).union(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Class of every document: (id, fp, component), component the least id that links of 2 or fewer bits reach.

    Null and blank texts have fingerprint zero and link like any other. Documents with one fingerprint form a class,
    linked once through its least id; ids may repeat, and extra columns of docs are ignored. An empty table gives an
    empty one.
    """
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = stored(fps.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-classes")
    ends = links(classes.select("fp"))
    named = ends.join(classes.toDF("a", "u").hint("merge"), "a").join(classes.toDF("b", "v").hint("merge"), "b").select("u", "v")
    roots = components(named)
    owner = classes.join(roots.hint("merge"), F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("root", "rep").alias("component"))
    return fps.join(owner.hint("merge"), "fp").select("id", "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """The rows of docs without near-duplicates: of each class the row with the least id stays, all columns as they are.

    Rows that repeat an id are judged together; rows without an id are left out.
    """
    kept = near_duplicates(docs, id_col, text_col, shingle).where("id = component").select(F.col("id").alias(id_col)).distinct()
    return docs.join(kept, id_col, "left_semi").select(docs.columns)
