"""Writes to the record store and to export packages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from examlake.functions import text as T
from examlake.operators import running
from examlake.operators.sampling import hashed
from examlake.operators.state import illegal_transitions
from examlake.operators.windows import complete_chunks


def with_ids(rows: DataFrame, subject: str, key: str, order: list[str], base: DataFrame | None = None, split: bool = False) -> DataFrame:
    """record_id, such as S01-003-Q0007, by order within a key, going on from the key's base.

    base: (key, base), the numbers already given; keys without one begin at 1. split: for few large keys, each of which
    is numbered by several tasks."""
    numbered = running.numbered(rows, [key], order, "_n") if split else rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    if base is not None:
        numbered = numbered.join(base, key, "left").withColumn("_n", F.col("_n") + F.coalesce("base", F.lit(0))).drop("base")
    return numbered.withColumn("record_id", F.format_string("%s-%s-Q%04d", F.col(subject), T.key_last(F.col(key)), F.col("_n"))).drop("_n")


def checked_updates(updates: DataFrame, known: DataFrame, key: str, allowed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) status updates (K3): of an unknown record or status, or by no allowed transition; rejected
    rows carry a reason. Accepted rows are the audit rows to append; the current state is the latest of each key."""
    marked = updates.join(known.select(key).distinct().withColumn("_known", F.lit(True)), key, "left")
    fine = marked.where("_known").drop("_known")
    bad = illegal_transitions(fine, allowed)
    rejected = marked.where("_known is null").drop("_known").withColumn("reason", F.lit("unknown record")).unionByName(bad.withColumn("reason", F.lit("transition")))
    same = fine["old_status"].eqNullSafe(allowed["old_status"]) & (fine["new_status"] == allowed["new_status"])
    return fine.join(allowed, same, "left_semi"), rejected


def replaced_stats(stats: DataFrame, counts: DataFrame, key: str, kept: str, columns: list[str]) -> DataFrame:
    """New counts in place of the old, the kept column as it was, 0 for new keys; keys without records stay, at 0 (K4)."""
    both = stats.select(key, kept).join(counts.select(key, *columns), key, "full")
    return both.select(key, *[F.coalesce(c, F.lit(0)).alias(c) for c in (kept, *columns)])


def claimed(status: Column, from_: str = "PENDING", to: str = "IN_PROGRESS") -> Column:
    """The status after a conditional update: only from_ becomes to (K7)."""
    return F.when(status == from_, F.lit(to)).otherwise(status)


def completed(results: DataFrame, decisions: tuple[str, ...] = ("PASS", "FAIL"), valid: int = 5) -> DataFrame:
    """Results that need no rerun."""
    return results.where(F.col("decision").isin(*decisions) & (F.col("valid_count") == valid))


def fresh(rows: DataFrame, baseline: DataFrame, exported: DataFrame, key: str) -> DataFrame:
    """Rows that are in neither the baseline nor the exports."""
    return rows.join(baseline.select(key), key, "left_anti").join(exported.select(key), key, "left_anti")


def untested(points: DataFrame, tested: DataFrame, subject: str, key: str, least: int) -> DataFrame:
    """Points not tested yet; all of a subject's where fewer than least remain."""
    marked = points.join(tested.select(key).distinct().withColumn("_tested", F.lit(True)), key, "left")
    left = marked.groupBy(F.col(subject).alias("_subject")).agg(F.count_if(F.col("_tested").isNull()).alias("_left"))
    counted = marked.join(left, marked[subject].eqNullSafe(left["_subject"]))
    return counted.where((F.col("_left") < least) | F.col("_tested").isNull()).drop("_tested", "_left", "_subject")


def zipped(a: DataFrame, b: DataFrame, group: list[str], a_order: list[str], b_order: list[str]) -> DataFrame:
    """The n-th row of a with the n-th of b within a group, as far as both go (J14). b keeps only columns a lacks."""
    place = lambda df, order: df.withColumn("_place", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return place(a, a_order).join(place(b, b_order), [*group, "_place"]).drop("_place")


def of_files(records: DataFrame, files: DataFrame, path: str, key: str) -> DataFrame:
    """Records of sampled files: a file's name, without its ending, is the record's id."""
    name = F.regexp_extract(F.col(path), r"([^/]+?)(\.[^./]*)?$", 1)
    return files.select(path, name.alias(key)).join(records, key)


def milestone_sample(rows: DataFrame, group: list[str], order: list[str], key: str, size: int = 100, n: int = 3, seed: int = 0) -> DataFrame:
    """n rows of each full hundred, by hash order (W2, K13); rows get chunk. Groups may be of any size."""
    chunks = complete_chunks(rows, group, order, size, split=True)
    rank = F.row_number().over(Window.partitionBy(*group, "chunk").orderBy(hashed(F.col(key), seed), key))
    return chunks.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def next_export(rows: DataFrame, exported: DataFrame, group: list[str], order: list[str], key: str, size: int = 10) -> DataFrame:
    """Full chunks of what was not exported before; a rest waits for the next run."""
    return complete_chunks(rows.join(exported.select(key), key, "left_anti"), group, order, size)


#: Fields of an exported item that must hold something.
REQUIRED = ("question_id", "subject_id", "subject_name", "kp_id", "question_text", "options", "correct_answer", "explanation")


def exported_items(rows: DataFrame, subjects: list[str], required: dict[str, Column], valid: Column) -> DataFrame:
    """rows with warnings: an invalid record, an excluded subject, or required fields that hold nothing."""
    gone = F.filter(F.array(*[F.when(F.coalesce(c.cast("string"), F.lit("")).isin("", "[]", "{}"), F.lit(f"missing_or_empty: {name}")) for name, c in required.items()]), lambda x: x.isNotNull())
    allowed = F.coalesce(F.col("subject_id").isin(*subjects), F.lit(False))
    outside = F.array(F.concat(F.lit("excluded_subject:"), F.coalesce("subject_id", F.lit(""))))
    return rows.withColumn("warnings", F.when(~valid, F.array(F.lit("invalid question_json"))).when(~allowed, outside).otherwise(gone)).withColumn("exported", valid & allowed)


def export_errors(items: DataFrame, images: DataFrame, subjects: DataFrame, total: int) -> DataFrame:
    """Errors of an export (G10, U5): (subject_id, error, n), subject_id null for the totals.

    items: (subject_id, image); images: (subject_id, image), the files there are; subjects: (subject_id). Counts of
    questions and files that differ; references without a file, empty ones too; files without a reference; and totals
    other than expected."""
    q = items.groupBy("subject_id").agg(F.count("*").alias("questions"))
    f = images.groupBy("subject_id").agg(F.count("*").alias("files"))
    counts = subjects.join(q, "subject_id", "left").join(f, "subject_id", "left").na.fill(0, ["questions", "files"])
    refs = items.select("subject_id", F.coalesce("image", F.lit("")).alias("image"))
    lost = refs.join(images.distinct(), ["subject_id", "image"], "left_anti").groupBy("subject_id").agg(F.count("*").alias("n"))
    extra = images.join(refs.distinct(), ["subject_id", "image"], "left_anti").groupBy("subject_id").agg(F.count("*").alias("n"))
    differ = counts.where("questions <> files").select("subject_id", F.lit("question_image_count_mismatch").alias("error"), F.abs(F.col("questions") - F.col("files")).alias("n"))
    sums = counts.agg(F.sum("questions").alias("questions"), F.sum("files").alias("files"))
    totals = sums.select(F.explode(F.array(F.struct(F.lit("total_question_count_mismatch").alias("error"), F.col("questions").alias("n")), F.struct(F.lit("total_image_count_mismatch").alias("error"), F.col("files").alias("n")))).alias("t"))
    off = totals.where(F.col("t.n") != total).select(F.lit(None).cast(items.schema["subject_id"].dataType).alias("subject_id"), "t.error", "t.n")
    return differ.unionByName(lost.withColumn("error", F.lit("missing_referenced_images"))).unionByName(extra.withColumn("error", F.lit("extra_unreferenced_images"))).unionByName(off)


def packages(items: DataFrame, subject: str, order: list[str], folder: str, per_file: int = 100_000) -> None:
    """One folder of JSON lines a subject, in order within a file, at most per_file items in one (K8)."""
    items.repartitionByRange(subject, *order).sortWithinPartitions(subject, *order).write.partitionBy(subject).option("maxRecordsPerFile", per_file).json(folder)


def index_document(counts: DataFrame, errors: DataFrame, version: str, fields: list[str]) -> DataFrame:
    """The index of an export as one JSON text (K9): counts of each subject, totals, errors, and PASS without any.

    counts: (subject_id, subject_name, questions, files), a row a subject."""
    subjects = F.sort_array(F.collect_list(F.struct("subject_id", "subject_name", "questions", "files")))  # one entry a subject
    one = counts.agg(subjects.alias("subjects"), F.sum("questions").alias("total_questions"), F.sum("files").alias("total_images"))
    faults = errors.groupBy("error").agg(F.sum("n").alias("n")).agg(F.sort_array(F.collect_list(F.struct("error", "n"))).alias("validation_errors"))  # one entry a kind
    status = F.when(F.size("validation_errors") == 0, "PASS").otherwise("FAIL").alias("validation_status")
    return one.join(faults).select(F.to_json(F.struct(F.lit(version).alias("version"), "total_questions", "total_images", "subjects", F.array(*map(F.lit, fields)).alias("schema_fields"), status, "validation_errors")).alias("document"))


def append_lines(rows: DataFrame, folder: str) -> None:
    """Rows appended as JSON lines: files of its own for each write, so that none needs a lock."""
    rows.write.mode("append").json(folder)


def snapshot(state: DataFrame, folder: str, version: int) -> str:
    """A state written whole under its version, which readers see only once it is complete."""
    path = f"{folder}/version={version:012d}"
    state.write.mode("overwrite").parquet(path)
    return path


def last_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The newest complete snapshot: one without Spark's mark of success is passed over."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    whole = [str(s.getPath()) for s in fs.listStatus(root) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return spark.read.parquet(max(whole))


def markdown(rows: DataFrame, columns: list[str], most: int = 1000) -> str:
    """A small report's table as Markdown (K14); most rows at most, with a line that says so if there are more."""
    found = rows.select(*columns).limit(most + 1).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(columns) + " |", "|" + "-|" * len(columns), *["| " + " | ".join(map(cell, r)) + " |" for r in found[:most]]]
    return "\n".join([*lines, *([f"(more than {most} rows)"] if len(found) > most else [])])


def cloned(spark: SparkSession, tables: dict[str, DataFrame], selected: DataFrame, key: str, folder: str) -> None:
    """A new store with the selected records' rows of every table, schemas as they are."""
    for name, table in tables.items():
        (table.join(selected.select(key), key, "left_semi") if key in table.columns else table).write.parquet(f"{folder}/{name}")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Items of files that each hold one JSON array."""
    return spark.read.schema(schema).option("multiLine", True).json(path)
