"""Line dedup: winnowing over line hashes, extended matches, later repeated runs deleted.

Lines are hashed in two tiers. A written line (up to a line end) of SHORT words or more is a unit of its own, and each
is selected. Passages also repeat in the middle of paragraphs, where line ends are no guide, so a run of LINE words
from every word on is a unit too: of each WINDOW of these in a row the least hash is selected, so any run of
LINE + WINDOW - 1 = 50 or more words that occurs twice shares a selected hash in both places. A shorter repeated run
that is no written line is cut where one of its units is selected, and stays where none is.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examlake.llm.common import slices, stored
from examlake.llm.mixing import mixed

LINE, WINDOW = 30, 21
#: Least words of a written line that is dealt with; from LINE + WINDOW - 1 words on, the other tier finds it.
SHORT = 8
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes whose words are hashed at once, and bytes of texts that are read together.
STEP, CHUNK = 1 << 16, 1 << 20


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> Powers:
        if n > len(self.up):
            size = max(2 * len(self.up), n)
            one = np.ones(1, np.uint64)
            self.up = np.concatenate([one, np.cumprod(np.full(size - 1, BASE))])
            self.down = np.concatenate([one, np.cumprod(np.full(size - 1, INVERSE))])
        return self


POWERS = Powers()


def words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and 64-bit hashes of a text's words."""
    raw = np.frombuffer(data, np.uint8)
    solid = np.zeros(len(raw) + 2, bool)
    solid[1:-1] = (raw != 32) & (raw - np.uint8(9) > 4)
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edge[::2], edge[1::2]
    h = np.empty(len(starts), np.uint64)
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(raw), STEP)), len(starts)))
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        part = raw[starts[a] : ends[z - 1]]  # of about STEP bytes, so that tables of powers stay small
        p, sums = POWERS.upto(len(part)), np.zeros(len(part) + 1, np.uint64)
        value = part.astype(np.uint64)
        value += np.uint64(1)
        value *= p.up[: len(part)]
        np.cumsum(value, out=sums[1:])
        first, end = starts[a:z] - starts[a], ends[a:z] - starts[a]
        h[a:z] = (sums[end] - sums[first]) * p.down[first]
    return starts, ends, mixed(h + (ends - starts).astype(np.uint64))


class Read(NamedTuple):
    """Texts read as one, a line end between them: byte starts and hashes of all words, and per text the byte at which
    it begins and its words' range."""

    data: bytes
    starts: np.ndarray
    h: np.ndarray
    at: np.ndarray
    first: np.ndarray
    end: np.ndarray


def together(texts: list[bytes | None]) -> Iterator[Read]:
    """Consecutive texts of CHUNK bytes or one more text at a time, as what is done once a text costs more than the
    text itself; null counts as empty."""

    def read() -> Read:
        data = b"\n".join(part)
        at = np.cumsum([0, *(len(t) + 1 for t in part)])
        starts, _, h = words(data)
        cuts = np.searchsorted(starts, at)
        return Read(data, starts, h, at[:-1], cuts[:-1], cuts[1:])

    part, size = [], 0
    for t in texts:
        part.append(t or b"")
        size += len(part[-1])
        if size >= CHUNK:
            yield read()
            part, size = [], 0
    if part:
        yield read()


def lines(h: np.ndarray, length: int = LINE) -> np.ndarray:
    """Hash of the length words from each word on; empty for shorter texts."""
    at = np.arange(max(0, len(h) - length + 1))
    return units(h, at, at + length)


def units(h: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words from each first to before its end."""
    p = POWERS.upto(len(h) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * p.up[: len(h)])])
    return mixed((sums[end] - sums[first]) * p.down[first])


def checked(h: np.ndarray, first: int, end: int) -> int:
    """A second hash of a range of words, independent of the one by which it was found."""
    return int.from_bytes(hashlib.blake2b(h[first:end].tobytes(), digest_size=8).digest(), "little", signed=True)


def written(data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ranges of the written lines of SHORT words or more that the other tier does not find for sure."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    cuts = np.unique(np.concatenate([[0], np.searchsorted(starts, ends), [len(starts)]]))
    n = np.diff(cuts)
    ok = (n >= SHORT) & (n < LINE + WINDOW - 1)
    return cuts[:-1][ok], cuts[1:][ok]


def winnowed(r: Read) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the lines of LINE words that are minima of WINDOW of their text in a row, or of all if it
    has fewer: leftmost on ties; in a stretch of one hash, every WINDOW-th position and the last."""
    each = lines(r.h)
    h = np.full(len(r.h) + WINDOW, np.iinfo(np.uint64).max)
    h[: len(each)] = each
    left = np.repeat(r.end, r.end - r.first) - np.arange(len(r.h))  # words of the text from each word on
    h[: len(r.h)][left < LINE] = h[-1]  # no line; being greatest and to the right of a text's lines, never the minimum
    least, at, width = h, np.arange(len(h), dtype=np.int32), 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        at = np.where(least[step:] < least[:-step], at[step:], at[:-step])
        least = np.minimum(least[:-step], least[step:])
        width += step
    whole = left >= LINE + WINDOW - 1
    whole[r.first[r.end - r.first >= LINE]] = True
    at = at[: len(r.h)][whole]
    found = at[np.diff(at, prepend=-1) > 0]
    new = np.ones(len(found), bool)
    new[1:] = (h[found[1:]] != h[found[:-1]]) | (np.diff(found) > 1)
    first = found[np.flatnonzero(new)[np.cumsum(new) - 1]]
    last = np.append(new[1:], True)[: len(found)]
    found = found[((found - first) % WINDOW == 0) | last]
    return found, h[found]


def selected(docs: DataFrame) -> DataFrame:
    """(h, id, pos, n) of the selected units, n words from pos on; docs: (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            ids, k = b.column(0).to_numpy(zero_copy_only=False), 0
            for r in together(b.column(1).cast(pa.binary()).to_pylist()):
                p, h = winnowed(r)
                first, end = written(r.data, r.starts)
                pos = np.concatenate([p, first])
                text = np.searchsorted(r.end, pos, side="right")
                n = np.concatenate([np.full(len(p), LINE), end - first])
                h = np.concatenate([h, units(r.h, first, end)])
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[k + text]), pa.array((pos - r.first[text]).astype(np.int32)), pa.array(n.astype(np.int16))], names=["h", "id", "pos", "n"])
                k += len(r.first)

    return docs.mapInArrow(run, "h long, id long, pos int, n short")


def runs(docs: DataFrame) -> DataFrame:
    """(id, src, runs: array<struct<first, end, src_first, src_end>>): words first.. of a document repeat those of an
    earlier place, the first in which their units occur. Matches of one offset that touch are one run."""
    lines_ = stored(selected(docs), "lines")
    firsts = stored(lines_.groupBy("h").agg(F.min(F.struct("id", "pos")).alias("s"), F.count("*").alias("m")).where("m > 1").select("h", F.col("s.id").alias("src"), F.col("s.pos").alias("src_pos")), "firsts")
    # Both sides are plain tables, so that Spark splits the partition of a frequent line's hash.
    met = lines_.join(firsts, "h").where("not (id = src and pos = src_pos)").select("id", "src", "pos", (F.col("pos") + F.col("n")).alias("end"), (F.col("pos") - F.col("src_pos")).alias("shift"))
    order = Window.partitionBy("id", "src", "shift").orderBy("pos", "end")  # no more rows than the document has lines
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = met.withColumn("part", F.sum((F.coalesce(before, F.lit(-1)) < F.col("pos")).cast("int")).over(order))
    each = marked.groupBy("id", "src", "shift", "part").agg(F.min("pos").alias("first"), F.max("end").alias("end"))
    run = F.struct("first", "end", (F.col("first") - F.col("shift")).alias("src_first"), (F.col("end") - F.col("shift")).alias("src_end"))
    return each.groupBy("id", "src").agg(F.collect_list(run).alias("runs"))  # no more than the document has lines


AROUND = "first int, end int, before binary, after binary, check long"


def contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(src, around: array<AROUND>): of each wanted range the hashes of the WINDOW words on either side, and a second
    hash of its own words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("before", pa.binary()), ("after", pa.binary()), ("check", pa.int64())]))
        for b in slices(batches):
            k = 0
            for t in together(b.column(1).cast(pa.binary()).to_pylist()):
                out = []
                for i, (a, z) in enumerate(zip(t.first.tolist(), t.end.tolist(), strict=True)):
                    h = t.h[a:z]
                    out.append([{**r, "before": h[max(0, r["first"] - WINDOW) : r["first"]].tobytes(), "after": h[r["end"] : r["end"] + WINDOW].tobytes(), "check": checked(h, r["first"], r["end"])} for r in b.column(2)[k + i].as_py()])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(k, len(out)), pa.array(out, kind)], names=["src", "around"])
                k += len(out)

    asked = wanted.distinct().groupBy("src").agg(F.collect_list(F.struct("first", "end")).alias("places"))  # at most one for each selected unit of src
    found = docs.join(asked, docs["id"] == asked["src"]).select("src", "text", "places")
    return found.mapInArrow(run, f"src long, around array<struct<{AROUND.replace(' ', ':').replace(',:', ',')}>>")


def extended(h: np.ndarray, runs_: list[dict]) -> list[tuple[int, int]]:
    """Word ranges of the runs whose words equal their source's, each extended both ways while the words equal those
    around its source; joined."""
    out: list[list[int]] = []
    for r in runs_:
        a, z = r["first"], r["end"]
        for c in r["around"]:
            if z > len(h) or checked(h, a, z) != c["check"]:
                continue
            before, after = np.frombuffer(c["before"], np.uint64), np.frombuffer(c["after"], np.uint64)
            n, m = min(len(before), a), min(len(after), len(h) - z)
            left, right = before[::-1][:n] == h[:a][::-1][:n], after[:m] == h[z : z + m]
            out.append([a - (n if left.all() else int(left.argmin())), z + (m if right.all() else int(right.argmin()))])
    out.sort()
    merged: list[list[int]] = []
    for a, z in out:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(z, merged[-1][1])
        else:
            merged.append([a, z])
    return [tuple(x) for x in merged]


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed: str = "removed") -> DataFrame:
    """docs with repeated runs cut from text_col, and a last column, named removed, of the word ranges [start, end)
    that went; it takes the place of a column of that name.

    The first place, by id and then position, stays; every later one goes with the blanks that follow it. All rows
    and columns stay, also of documents that end up empty. Null texts stay null. Rows that repeat an id are one
    document with several texts: a run of any is cut from each where its words stand at that place; rows without an id
    stay as they are. An empty table gives an empty one.
    """
    docs = docs.drop(removed)
    key, found_ = f"id_{uuid.uuid4().hex}", f"runs_{uuid.uuid4().hex}"
    at, names = docs.columns.index(text_col), docs.columns
    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    found = stored(runs(flat), "runs")
    places = found.select("src", F.explode("runs").alias("r")).select("src", F.col("r.src_first").alias("first"), F.col("r.src_end").alias("end"))
    around = stored(contexts(flat, places), "contexts")
    of = lambda r: F.filter("around", lambda c: (c["first"] == r["src_first"]) & (c["end"] == r["src_end"]))
    known = F.transform("runs", lambda r: F.struct(r["first"].alias("first"), r["end"].alias("end"), of(r).alias("around")))
    per_doc = found.join(around, "src").select("id", known.alias("runs")).groupBy(F.col("id").alias(key)).agg(F.flatten(F.collect_list("runs")).alias(found_))  # no more than its lines
    joined = docs.withColumn(key, F.col(id_col).cast("long")).join(per_doc, key, "left").drop(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in slices(batches):
            texts, met, gone = b.column(at).cast(pa.binary()).to_pylist(), b.column(len(names)), [[]] * b.num_rows
            rows = [i for i, t in enumerate(texts) if t is not None and met[i].is_valid]
            todo = iter(rows)
            for t in together([texts[i] for i in rows]):
                for begin, first, end in zip(t.at.tolist(), t.first.tolist(), t.end.tolist(), strict=True):
                    i = next(todo)
                    data = texts[i]
                    ranges = extended(t.h[first:end], met[i].as_py())
                    kept, last = [], 0
                    for a, z in ranges:
                        kept.append(data[last : t.starts[first + a] - begin])
                        last = t.starts[first + z] - begin if first + z < end else len(data)
                    kept.append(data[last:])
                    texts[i] = b"".join(kept)
                    gone[i] = [{"start": a, "end": z} for a, z in ranges]
            columns = list(b.columns[:-1])
            columns[at] = pa.array(texts, pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gone, span)], names=[*names, removed])

    schema = T.StructType([*docs.schema.fields, T.StructField(removed, T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
    return joined.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """Per row: how many words went, which ranges of words, and SHA-256 of what is left; rows as deduplicated() has
    them, a null text counting as empty."""
    out = deduplicated(docs.select("doc_id", "text"))
    words_ = F.aggregate("removed", F.lit(0).cast("long"), lambda n, g: n + (g["end"] - g["start"]).cast("long"))
    ranges = F.array_join(F.transform("removed", lambda g: F.concat_ws(":", g["start"], g["end"])), ",")
    return out.select("doc_id", words_.alias("removed_words"), ranges.alias("removed"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def cleaned(docs: DataFrame) -> DataFrame:
    """docs without later repeated runs, with docs' columns (n_chars made anew); documents that lose every word go.

    Other columns may have any name; nulls and repeated ids as in deduplicated()."""
    gone = f"removed_{uuid.uuid4().hex}"
    out = deduplicated(docs, removed=gone).where((F.size(gone) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(gone) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.drop(gone)
