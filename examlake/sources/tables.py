"""Loaders of the tables, and of nested, lenient, incremental and listed inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lenient_int(value: Column) -> Column:
    """int(float(x or 0)): text that is no number counts as 0, decimals are cut off."""
    return F.coalesce(value.cast("string").try_cast("double"), F.lit(0.0)).cast("int")


def display_name(value: Column) -> Column:
    """A name that is a JSON string or an object with zh, name or en (S7); plain text stays as it is."""
    v = F.try_parse_json(value)
    parts = [F.try_variant_get(v, p, "string") for p in ("$.zh", "$.name", "$.en")]
    return F.coalesce(*parts, F.try_variant_get(v, "$", "string"), value)


def knowledge_points(taxonomy: DataFrame) -> DataFrame:
    """(subject_id, subject_name, module_id, knowledge_point_id) of a taxonomy whose points stand under modules, at the
    top, or both (S5)."""
    module = F.explode_outer("modules").alias("m")
    nested = taxonomy.select("subject_id", "subject_name", module).select("subject_id", "subject_name", F.col("m.module_id").alias("module_id"), F.explode("m.knowledge_points").alias("k"))
    top = taxonomy.select("subject_id", "subject_name", F.lit(None).cast("string").alias("module_id"), F.explode("knowledge_points").alias("k"))
    return nested.unionByName(top).select("subject_id", "subject_name", "module_id", F.col("k.knowledge_point_id").alias("knowledge_point_id"))


def lookup(spark: SparkSession, folder: str, name: str, key: str, value: object) -> DataFrame:
    """Rows of one key; the test reaches the scan, which passes over row groups that cannot hold it."""
    return load(spark, folder, name).where(F.col(key) == value)


def pinned(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A table as it was when its path was written: versions are folders that no later write touches (S3)."""
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def dimension_csv(spark: SparkSession, path: str, numbers: dict[str, str], texts: dict[str, str]) -> DataFrame:
    """A CSV file with a header, every column as text first: numbers (output name: column) by lenient_int, texts
    trimmed, empty where missing (S6)."""
    raw = spark.read.option("header", True).csv(path)
    has = lambda c: F.col(c) if c in raw.columns else F.lit(None).cast("string")
    return raw.select(*[F.trim(F.coalesce(has(c), F.lit(""))).alias(n) for n, c in texts.items()], *[lenient_int(has(c)).alias(n) for n, c in numbers.items()])


def tailed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """New lines of log files; the checkpoint remembers what was read."""
    return spark.readStream.text(folder)


def listing(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(path, length, modificationTime) of the files below a folder with a suffix; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(folder)
    return found.select("path", "length", "modificationTime")


def controls(spark: SparkSession, path: str, defaults: dict[str, object]) -> DataFrame:
    """One row of settings from a small JSON file, read anew at each call, defaults where it has none."""
    schema = spark.createDataFrame([tuple(defaults.values())], list(defaults)).schema
    found = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path).limit(1)
    filled = spark.range(1).join(found, how="left") if defaults else spark.range(1)
    return filled.select(*[F.coalesce(F.col(k), F.lit(v)).alias(k) for k, v in defaults.items()])
