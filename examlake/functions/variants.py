"""JSON as VARIANT: whole texts, kinds, truth, leaves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A token of JSON: a string, with the colon behind it if it is a key, or a number, true, false or null. Possessive, so
#: that the matcher neither backtracks nor recurses on long strings.
TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\s*+:)?+|[^\s\[\]{},:"]++'
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def part(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def text_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def whole(json: Column) -> Column:
    """The value of a JSON text, or null if it is not one value and nothing behind it.

    The parser passes over what follows a value. Within an array and within an object it cannot: what closes the one
    too early breaks the other. Only texts with a square bracket can close the array, so only these are parsed twice.
    """
    inside, named = F.try_parse_json(F.concat(F.lit("["), json, F.lit("]"))), F.try_parse_json(F.concat(F.lit('{"a":'), json, F.lit("}")))
    return let(inside, lambda v: F.when(part(v, "$[1]").isNull() & (~F.contains(json, F.lit("]")) | named.isNotNull()), part(v, "$[0]")))


def kind(v: Column) -> Column:
    """OBJECT, ARRAY or the type of a scalar; null without a value."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def holds(v: Column) -> Column:
    """Whether a value is there and is not null, empty, zero or false."""
    return let(F.to_json(v), lambda value: F.coalesce(~value.isin("null", '""', "[]", "{}", "false") & ~value.rlike(r"^-?0(\.0*)?(E[+-]?\d+)?$"), F.lit(False)))


def leaves(json: Column) -> Column:
    """The scalars of a JSON text, at any depth, in its order, as JSON texts; keys are none of them.

    One pass of a tokeniser, so nesting has no bound.
    """
    return F.filter(F.regexp_extract_all(json, F.lit(TOKEN), F.lit(0)), lambda x: ~x.endswith(":"))


def leaf_values(json: Column) -> Column:
    """The same as values: strings without quotes and escapes, numbers and booleans as written, null as null."""
    return F.from_json(F.concat(F.lit("["), F.array_join(leaves(json), ","), F.lit("]")), "array<string>")


def leaf_strings(json: Column) -> Column:
    """The strings among them alone."""
    return F.from_json(F.concat(F.lit("["), F.array_join(F.filter(leaves(json), lambda x: x.startswith('"')), ","), F.lit("]")), "array<string>")


def running_text(json: Column) -> Column:
    """The leaves a line each, as the gates read them: null, false and zero leave an empty line."""
    none = r"^(null|false|-?0(\.0*)?([eE][+-]?\d+)?)$"
    kept = F.transform(leaves(json), lambda x: F.when(x.rlike(none), '""').otherwise(x))
    return F.array_join(F.from_json(F.concat(F.lit("["), F.array_join(kept, ","), F.lit("]")), "array<string>"), "\n")


def depth(json: Column) -> Column:
    """How many brackets stand within each other at most; null without a text."""
    brackets = F.regexp_replace(F.regexp_replace(json, STRING, ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(a: Column, c: Column) -> Column:
        now = a["now"] + F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(a["most"], now).alias("most"))

    return F.aggregate(F.split(brackets, ""), start, step, lambda a: a["most"])


def leaf_rows(rows: DataFrame, json: str, keys: list[str]) -> DataFrame:
    """(keys, path, kind, value): a row for each scalar of each JSON text, with its path ($.a[0].b) and its text.

    Each step of the recursion opens what is still an object or a list (a lateral variant_explode) and lets scalars
    pass, so that rows are read once; the texts' greatest depth, measured first, is the number of steps. Texts that are
    no JSON give no rows, nor do empty objects and lists.
    """
    spark = rows.sparkSession
    v = F.col("_v")
    steps = rows.agg(F.max(F.when(whole(F.col(json)).isNotNull(), depth(F.col(json)))).alias("n")).first()["n"] or 0
    out = rows.select(*keys, F.lit("$").alias("path"), whole(F.col(json)).alias("_v")).where(v.isNotNull())
    for _ in range(steps):
        opened = out.withColumn("_open", kind(v).isin("OBJECT", "ARRAY"))
        inner = spark.tvf.variant_explode_outer(F.when(F.col("_open"), v).outer())
        each = opened.lateralJoin(inner).where(~F.col("_open") | F.col("pos").isNotNull())
        step = F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), F.col("key")))
        out = each.select(*keys, F.when(F.col("_open"), F.concat("path", step)).otherwise(F.col("path")).alias("path"), F.when(F.col("_open"), F.col("value")).otherwise(v).alias("_v"))
    return out.where(~kind(v).isin("OBJECT", "ARRAY")).select(*keys, "path", kind(v).alias("kind"), F.try_variant_get(v, "$", "string").alias("value"))
