"""Recorded model answers as a data source: batch, and a stream that goes on from its offset.

The line's calls go to services outside; what they said is kept in Parquet files, and replayed from there: tests and
analyses read the same answers again and again. A recording is a folder or a file of rows (item, idx, body), body being
a service's reply in JSON.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "item long, idx int, answer string, status string, file string"
NAMES = ["item", "idx", "answer", "status", "file"]


class RowGroup(InputPartition):
    """One row group of one file: what a task replays."""

    def __init__(self, file: str, number: int):
        super().__init__((file, number))
        self.file, self.number = file, number


def said(body: str | None) -> tuple[str | None, str]:
    """(answer, status) of a reply: the text of its first choice, or of its first content part; no text is an empty
    answer. status: ok, empty, or failed for no reply, one that is no JSON object, or one that names an error."""
    try:
        reply = json.loads(body or "")
    except (ValueError, RecursionError):
        return None, "failed"
    if not isinstance(reply, dict) or reply.get("error"):
        return None, "failed"
    first = lambda x: x[0] if isinstance(x, list) and x and isinstance(x[0], dict) else {}
    message = first(reply.get("choices")).get("message")
    text = message.get("content") if isinstance(message, dict) else first(reply.get("content")).get("text")
    text = text if isinstance(text, str) else ""
    return text, "ok" if text else "empty"


def replayed(file: str, number: int) -> Iterator[pa.RecordBatch]:
    """The answers of one row group, by batches."""
    with pq.ParquetFile(file) as source:
        for b in source.iter_batches(1024, row_groups=[number], columns=["item", "idx", "body"]):
            answers = [said(x) for x in b.column("body").to_pylist()]
            columns = [b.column("item").cast(pa.int64()), b.column("idx").cast(pa.int32()), pa.array([a for a, _ in answers], pa.string()), pa.array([s for _, s in answers]), pa.array([Path(file).name] * b.num_rows)]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)


def files(path: str) -> list[str]:
    """The recording's files by name; files whose names begin with a dot or underscore are still being written."""
    root = Path(path.removeprefix("file://"))
    if root.is_file():
        return [str(root)]
    return sorted(str(p) for p in root.rglob("*.parquet") if not any(x[0] in "._" for x in p.relative_to(root).parts))


def row_groups(names: list[str]) -> list[RowGroup]:
    return [RowGroup(f, i) for f in names for i in range(pq.read_metadata(f).num_row_groups)]


class Replay(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[RowGroup]:
        return row_groups(files(self.path))

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        return replayed(partition.file, partition.number)


class StreamReplay(DataSourceStreamReader):
    """Files in order of their names, which must grow as they are recorded; the offset is the last file that was read,
    so a restart goes on behind it."""

    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {"last": ""}

    def latestOffset(self) -> dict:
        there = files(self.path)
        return {"last": Path(there[-1]).name if there else ""}

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        return row_groups([f for f in files(self.path) if start["last"] < Path(f).name <= end["last"]])

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        return replayed(partition.file, partition.number)

    def commit(self, end: dict) -> None:
        pass


class RecordedAnswers(DataSource):
    """spark.read.format("recorded_answers").load(path), after register(spark)."""

    @classmethod
    def name(cls) -> str:
        return "recorded_answers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Replay:
        return Replay(self.options["path"])

    def streamReader(self, schema) -> StreamReplay:
        return StreamReplay(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordedAnswers)


def reply(text: Column, kind: Column) -> Column:
    """A service's reply around a text, as it is recorded: of the one form or the other, or an error."""
    choices = F.to_json(F.struct(F.array(F.struct(F.struct(text.alias("content")).alias("message"))).alias("choices")))
    parts = F.to_json(F.struct(F.array(F.struct(text.alias("text"))).alias("content")))
    return F.when(kind == "choices", choices).when(kind == "parts", parts).when(kind == "error", F.lit('{"error": {"code": 429}}')).when(kind == "none", F.lit('{"choices": []}'))
