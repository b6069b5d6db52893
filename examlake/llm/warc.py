"""WARC archives: a deterministic sharded writer, and a reader."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from examlake.llm.common import partitions, scratch, stored

#: A file is closed with the record that brings it to this many compressed bytes.
ROLL_BYTES = 16 << 20
#: Payload bytes of a shard.
SHARD_BYTES = 32 << 20
#: Every record carries this time: reruns give the same bytes.
DATE = "2024-01-01T00:00:00Z"


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that all executors reach (file:, hdfs:, s3:, gs: and so on)."""
    return pafs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def record_id(page_id: int, digest: str, copy: int = 0) -> str:
    """Ids differ by page_id, payload, and place among rows that are alike in both."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}:{digest}:{copy}')}>"


def record(page_id: int, url: str, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None, copy: int = 0) -> bytes:
    """One gzip member: a response with its payload, or a revisit that names the response and carries none.

    The profile of a revisit holds its own digest and the length of the full payload, so that a reader needs no other
    record to give both.
    """
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest, copy)), ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url)), ("X-Page-ID", str(page_id)), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
    ]
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to)), ("WARC-Refers-To-Target-URI", "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in refers_url or "")), ("WARC-Truncated", "length")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip header without time or name: the same bytes on every run
    return z.compress(raw) + z.flush()


def records(stream) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(headers, HTTP head, payload) of each record of a .warc.gz stream, one gzip member after the other."""
    z, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(1 << 20)
        if not data:
            break
        parts.append(z.decompress(data))
        rest = z.unused_data
        if z.eof:
            raw = b"".join(parts)
            z, parts = zlib.decompressobj(31), []
            head, _, body = raw.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            block = body[: int(fields["Content-Length"])]
            if "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode() != fields["WARC-Block-Digest"]:
                raise ValueError(f"digest of {fields['WARC-Record-ID']} does not hold")
            http, _, payload = block.partition(b"\r\n\r\n")
            yield fields, http, payload
    if any(parts):
        raise ValueError("the archive ends within a record")


def borders(pages: DataFrame) -> np.ndarray:
    """The least page_id of each shard: ids in order, by running sums of payload bytes, however they are spread.

    The sums are exact, so that borders depend on neither partitions nor sampling. What the driver gets is one number a
    shard, 8 bytes for SHARD_BYTES of payload.
    """
    n = partitions(pages.sparkSession)
    sizes = pages.groupBy("page_id").agg(F.sum(F.octet_length("payload") + 512).alias("n"))
    ranged = stored(sizes.repartitionByRange(n, "page_id").withColumn("pid", F.spark_partition_id()), "warc-sizes")
    sums = ranged.groupBy("pid").agg(F.sum("n").alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("pid")) - F.col("n")).drop("n")  # one row a partition
    inside = F.sum("n").over(Window.partitionBy("pid").orderBy("page_id")) - F.col("n")
    at = ranged.withColumn("inside", inside).join(F.broadcast(sums), "pid").withColumn("shard", F.floor((F.col("before") + F.col("inside")) / SHARD_BYTES))
    return np.sort(at.groupBy("shard").agg(F.min("page_id").alias("first")).toPandas()["first"].to_numpy(np.int64))


def shard_column(pages: DataFrame) -> Column:
    """A shard number, ascending with page_id; a page's rows always share a shard."""
    first = borders(pages)

    @F.pandas_udf("int")
    def shard(ids: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(first, ids.to_numpy(np.int64), side="right") - 1, 0).astype(np.int32))

    return shard("page_id")


def revisits(pages: DataFrame) -> DataFrame:
    """pages with refers_to and refers_url: of equal payloads the largest page_id is the response the others name.

    Sums per digest are taken before the shuffle; only digests of two or more pages are joined back.
    """
    most = pages.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("last"), F.count("*").alias("n")).where("n > 1")
    other = F.col("last.page_id") != F.col("page_id")
    return pages.join(most, "digest", "left").withColumns({"refers_to": F.when(other, F.col("last.page_id")), "refers_url": F.when(other, F.col("last.url"))}).drop("last", "n")


MANIFEST = "shard int, part int, temporary string, name string, n_records long, n_bytes long, sha1 string"


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages (page_id, url, html) as folder/part-SSSSS-NNNN.warc.gz; returns the manifest (folder/manifest).

    Shards are dealt to tasks in turn, whole: each task has as many as the next. A shard's records are sorted by page_id,
    and then by digest and url.

    Tasks write under names of their own attempt; the manifest lists those of the attempts that counted, a second job
    moves them to their final names, where a repeated move finds its work done. Files of lost attempts stay under
    temporary/ and are never read. Null html counts as empty, a null url as ''; rows without page_id are left out; rows
    that repeat a page_id are all written, under record ids of their own. Extra columns are ignored; no rows give an
    empty manifest.
    """
    spark = pages.sparkSession
    flat = pages.where("page_id is not null").select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    flat = flat.withColumn("digest", F.unhex(F.sha1("payload")))
    keys = revisits(flat.select("page_id", "url", "digest")).where("refers_to is not null").select("page_id", "digest", "refers_to", "refers_url").dropDuplicates(["page_id", "digest"])
    # Pages and what revisits refer to are dealt once, together: a reference stands before the rows it is for.
    notes = keys.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "refers_to", "refers_url")
    bare = flat.select("*", F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_url"))
    marked = bare.unionByName(notes).withColumn("shard", shard_column(flat))
    n = partitions(spark)
    ordered = marked.repartitionById(n, F.pmod("shard", F.lit(n))).sortWithinPartitions("shard", "page_id", "digest", F.col("payload").isNotNull(), "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        tag = f"{task.stageId()}-{task.partitionId()}-{task.attemptNumber()}-{uuid.uuid4().hex}"
        fs, root = opened(folder)
        fs.create_dir(f"{root}/temporary", recursive=True)
        out, row, sums, part, shard, note, last, copy = None, None, None, 0, None, {}, None, 0

        def closed() -> pa.RecordBatch:
            nonlocal out
            out.close()
            out = None
            return pa.RecordBatch.from_pylist([row | {"sha1": sums.hexdigest()}], schema=pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("temporary", pa.string()), ("name", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64()), ("sha1", pa.string())]))

        for b in batches:
            for i in range(b.num_rows):
                r = {k: v[0].as_py() for k, v in zip(b.schema.names, b.slice(i, 1).columns, strict=True)}
                if r["payload"] is None:
                    note = r
                    continue
                if (r["page_id"], r["digest"]) == (note.get("page_id"), note.get("digest")):
                    r |= {"refers_to": note["refers_to"], "refers_url": note["refers_url"]}
                if out is not None and (r["shard"] != shard or row["n_bytes"] >= ROLL_BYTES):
                    part = 0 if r["shard"] != shard else part + 1
                    yield closed()
                if out is None:
                    part, shard = part if r["shard"] == shard else 0, r["shard"]
                    name = f"part-{shard:05d}-{part:04d}.warc.gz"
                    row, sums = {"shard": shard, "part": part, "temporary": f"temporary/{tag}-{name}", "name": name, "n_records": 0, "n_bytes": 0}, hashlib.sha1()
                    out = fs.open_output_stream(f"{root}/{row['temporary']}", compression=None)
                last, copy = (r["page_id"], r["digest"]), copy + 1 if last == (r["page_id"], r["digest"]) else 0
                data = record(r["page_id"], r["url"], r["payload"], base64.b32encode(r["digest"]).decode(), r["refers_to"], r["refers_url"], copy)
                out.write(data)
                sums.update(data)
                row["n_records"] += 1
                row["n_bytes"] += len(data)
        if out is not None:
            yield closed()

    ordered.select("shard", "page_id", "url", "payload", "digest", "refers_to", "refers_url").mapInArrow(run, MANIFEST).write.parquet(f"{folder}/attempts")

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(folder)
        for b in batches:
            for r in b.to_pylist():
                done = fs.get_file_info(f"{root}/{r['name']}")
                if done.type == pafs.FileType.NotFound:
                    try:
                        fs.move(f"{root}/{r['temporary']}", f"{root}/{r['name']}")
                    except OSError:  # another attempt of this task has just moved it
                        pass
                if fs.get_file_info(f"{root}/{r['name']}").size != r["n_bytes"]:
                    raise OSError(f"{r['name']} is not whole")
            yield b

    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/attempts")
    listed.repartition(partitions(spark)).mapInArrow(moved, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the archives that the manifest lists, as read from the files: (page_id, url, record_type,
    payload_bytes, payload_digest, refers_to, payload); a revisit's payload is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for b in batches:
            for name in b.column(0).to_pylist():
                held, size = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for h, http, payload in records(stream):
                        response = h["WARC-Type"] == "response"
                        refers, digest = h.get("X-Refers-To-Page-ID"), h["WARC-Payload-Digest"].removeprefix("sha1:")
                        n = int(http.rpartition(b"Content-Length: ")[2])
                        if response and (len(payload) != n or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                            raise ValueError(f"payload of page {h['X-Page-ID']} is not whole")
                        held.append({"page_id": int(h["X-Page-ID"]), "url": h["WARC-Target-URI"], "record_type": h["WARC-Type"], "payload_bytes": n, "payload_digest": digest, "refers_to": int(refers) if refers else None, "payload": payload if response else None})
                        size += len(payload) + 100
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("name")
    return files.repartition(partitions(spark), "name").mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages to archives in the shared folder and reads these back."""
    folder = scratch(pages.sparkSession, "warc")
    write(pages, folder)
    return read(pages.sparkSession, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
