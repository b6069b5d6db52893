"""Protected phrases within texts, in time linear in the texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

#: Characters of a gram; shorter phrases are not looked for.
GRAM = 8
#: Characters that the phrases may have together to be handed to all tasks; more are met by a join on grams.
CARRIED = 16_000_000
#: Texts taken out of an Arrow batch at a time.
TEXTS = 256


def gram_hashes(text: str) -> np.ndarray:
    """Hash of the GRAM characters from each place on; a fixed number of passes over the text, whatever its length."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(points) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(GRAM):
            h = (h + points[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h.view(np.int64)


def grams(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, gram, at): each text's distinct grams, with the first place of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, TEXTS):
                part = b.slice(at, TEXTS)
                found = [np.unique(gram_hashes(x or ""), return_index=True) for x in part.column(1).to_pylist()]
                who = pa.array(np.repeat(np.arange(part.num_rows), [len(h) for h, _ in found]))
                yield pa.RecordBatch.from_arrays([part.column(0).take(who), pa.array(np.concatenate([h for h, _ in found])), pa.array(np.concatenate([i for _, i in found]).astype(np.int32))], names=["key", "gram", "at"])

    schema = t.StructType([t.StructField("key", rows.schema[key].dataType), t.StructField("gram", t.LongType()), t.StructField("at", t.IntegerType())])
    return rows.select(key, text).mapInArrow(run, schema)


def anchored(phrases: DataFrame, key: str, phrase: str) -> DataFrame:
    """(key, phrase, gram, at): each phrase by that of its grams which fewest phrases have, so that few hang on one."""
    each = grams(phrases, key, phrase)
    shared = each.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = each.join(shared, "gram").groupBy("key").agg(F.min(F.struct("n", "gram", "at")).alias("a"))
    return phrases.select(F.col(key).alias("key"), F.col(phrase).alias("phrase")).join(rarest, "key").select("key", "phrase", "a.gram", "a.at")


def met(text: str, grams_: np.ndarray, at: list[int], phrases: list[str]) -> list[int]:
    """Which phrases stand in a text; grams_ is sorted, and has the grams of phrases in their order, each `at` so far
    into its phrase."""
    h = gram_hashes(text)
    place = np.searchsorted(grams_, h)
    place[place == len(grams_)] = 0
    out: set[int] = set()
    for i in np.flatnonzero(grams_[place] == h).tolist():
        k = int(place[i])
        while k < len(phrases) and grams_[k] == h[i]:
            if k not in out and i >= at[k] and text.startswith(phrases[k], i - at[k]):
                out.add(k)
            k += 1
    return sorted(out)


def leaks(texts: DataFrame, phrases: DataFrame, text: str, phrase: str, text_key: str, phrase_key: str, least: int = GRAM, carried: int = CARRIED) -> DataFrame:
    """(text_key, phrase_key), once each, where a phrase of least or more characters stands in a text, both as given.

    A phrase is looked for by one gram of its own; a text is hashed gram by gram in passes of linear time, and compared
    only where a phrase's gram is. Phrases of up to `carried` characters in all, which is measured, are handed to the
    tasks and the texts stay where they are; more are met by an equi-join on grams, in which a text's distinct grams
    travel, and its whole text once for the phrases it may hold. Null texts, phrases and keys give no rows; rows that
    repeat a key count as one.
    """
    if least < GRAM:
        raise ValueError(f"phrases are found by {GRAM} characters")
    spark = texts.sparkSession
    known = phrases.where(F.col(phrase_key).isNotNull() & (F.length(phrase) >= least)).select(phrase_key, phrase).distinct()
    # Rows that repeat a key are told apart by a number until the end.
    marks = known.select(F.struct(phrase_key, phrase).alias("name"), F.col(phrase))
    rows = texts.where(F.col(text_key).isNotNull() & (F.length(text) >= least)).select(text_key, text)
    if known.agg(F.coalesce(F.sum(F.length(phrase)), F.lit(0)).alias("n")).first()["n"] > carried:
        return _joined(rows, anchored(marks, "name", phrase), text, text_key, phrase_key)
    held = sorted((r["gram"], r["at"], r["phrase"], r["key"][phrase_key]) for r in anchored(marks, "name", phrase).collect())
    shared = spark.sparkContext.broadcast((np.array([g for g, *_ in held], np.int64), [a for _, a, *_ in held], [p for _, _, p, _ in held], [k for *_, k in held]))
    kinds = {n: d.schema[n].dataType for d, n in ((texts, text_key), (phrases, phrase_key))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_, at, wanted, names = shared.value
        for b in batches:
            for start in range(0, b.num_rows if wanted else 0, TEXTS):
                part = b.slice(start, TEXTS)
                pairs = [(i, k) for i, x in enumerate(part.column(1).to_pylist()) for k in met(x, grams_, at, wanted)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([i for i, _ in pairs], pa.int64())), pa.array([names[k] for _, k in pairs], kind)], names=[text_key, phrase_key])

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(kinds[phrase_key])
    schema = t.StructType([t.StructField(n, d) for n, d in kinds.items()])
    return rows.mapInArrow(run, schema).distinct()


def _joined(rows: DataFrame, known: DataFrame, text: str, text_key: str, phrase_key: str) -> DataFrame:
    numbered = rows.select(F.struct(text_key, F.xxhash64(text).alias("h")).alias("row"), F.col(text).alias("text"))
    places = grams(numbered, "row", "text").select(F.col("key").alias("row"), "gram").distinct()
    near = places.join(known.select("gram", "key", "phrase"), "gram").select("row", "key", "phrase")
    return near.join(numbered, "row").where(F.contains("text", "phrase")).select(F.col(f"row.{text_key}"), F.col(f"key.{phrase_key}")).distinct()
