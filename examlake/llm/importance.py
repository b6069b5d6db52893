"""Target-distribution importance resampling over hashed n-grams, in DataFrame functions alone."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examlake.llm.common import let, partitions, stored

#: Words: runs of ASCII letters and digits and of all characters beyond ASCII.
FEATURE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Buckets of features; the table of gains has one row for each, so this bounds what is broadcast.
BUCKETS = 10_000


def words(text: Column) -> Column:
    """The words of a whole text, A-Z in lower case; null gives none."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(low, F.lit(FEATURE_WORD), F.lit(0))


def features(text: Column, n: int) -> Column:
    """All runs of 1 to n consecutive words of a text, joined by one space."""
    if n == 1:
        return words(text)

    def runs(w: Column) -> Column:
        def run(size: int) -> Column:
            starts = F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size)).otherwise(F.array().cast("array<int>"))
            # slice() would copy the whole array for each run.
            return F.transform(starts, lambda i: F.concat_ws(" ", *(F.get(w, i + k) for k in range(size))))

        return F.concat(w, *(run(size) for size in range(2, n + 1)))

    return let(words(text), runs)


def bucket(feature: Column, buckets: int = BUCKETS) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def bucket_counts(texts: DataFrame, text_col: str = "text", n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of all texts; counted within tasks before the shuffle."""
    every = texts.select(F.explode(features(F.col(text_col), n)).alias("feature"))
    return every.groupBy(bucket(F.col("feature"), buckets).alias("bucket")).agg(F.count("*").alias("n"))


def gain_table(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, text_col: str = "text") -> DataFrame:
    """(bucket, gain) for every bucket: floor(1000 ln) of the target's smoothed share over the corpus's; one row a bucket."""
    spark = docs.sparkSession
    raw = bucket_counts(docs, text_col, n, buckets).withColumnRenamed("n", "s")
    aim = bucket_counts(target, text_col, n, buckets).withColumnRenamed("n", "t")
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    counts = every.join(raw, "bucket", "left").join(aim, "bucket", "left").select("bucket", zero(F.col("s")).alias("s"), zero(F.col("t")).alias("t"))
    whole = Window.partitionBy(F.lit(0))  # `buckets` rows, whatever the corpus
    ratio = ((F.col("t") + 1) * (F.sum("s").over(whole) + buckets)) / ((F.col("s") + 1) * (F.sum("t").over(whole) + buckets))
    return counts.select("bucket", F.floor(1000 * F.ln(ratio)).cast("long").alias("gain"))


def weighed(docs: DataFrame, gains: DataFrame, n: int = 1, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_features, n_words, weight): the floored mean of the gains of each row's features.

    Sums are made where a row's features are exploded; of a row, its id and hash and two numbers are shuffled. Rows
    alike in id and text have one sum, which is divided by their number and given for each.
    """
    key = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # Single words come first among the features, so a place below their number is a word's.
    n_words = F.size(words(F.col("text"))) if n > 1 else F.lit(2**31 - 1)
    # What stands beside a generator is computed after it: hash and size come first, so that no text goes with each feature.
    held = key.select("id", F.xxhash64("text").alias("h"), n_words.alias("n_words"), features(F.col("text"), n).alias("all"))
    rows = held.select("id", "h", "n_words", F.posexplode_outer("all").alias("pos", "feature"))
    named = rows.withColumn("bucket", bucket(F.col("feature"), buckets))
    # The gains are one row a bucket: a size bounded by `buckets`.
    gained = named.join(F.broadcast(gains), "bucket", "left")
    sums = gained.groupBy("id", "h").agg(
        F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("copies"), F.count("pos").alias("features"), F.count_if(F.col("pos") < F.col("n_words")).alias("words"), F.coalesce(F.sum("gain"), F.lit(0)).alias("gain")
    )
    each = sums.withColumn("m", F.greatest(F.col("features"), F.lit(1)))
    # `gain` and `features` hold all copies: the quotient is one copy's.
    weight = F.expr("(gain - pmod(gain, m)) div m")
    one = each.select("id", (F.col("features") / F.col("copies")).cast("long").alias("n_features"), (F.col("words") / F.col("copies")).cast("long").alias("n_words"), weight.alias("weight"), "copies")
    return one.select("id", "n_features", "n_words", "weight", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")


def noisy(weight: Column, id_: Column, seed: int = 2024) -> Column:
    """The weight with Gumbel noise that depends on seed and id alone, in thousandths; null without an id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return weight + F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame) -> DataFrame:
    """rows with at, score's place in descending order (ties to smaller ids) from 1 on, and n, the number of rows.

    A range partition is sorted in its tasks and written with each row's place in its partition; the partitions' sizes,
    a row a partition, give what is added to it.
    """
    order = [F.desc("score"), F.col("id").asc(), F.col("n_features").asc(), F.col("weight").asc()]
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    held = stored(dealt.withColumn("place", F.monotonically_increasing_id()), "importance-sorted")
    part = F.shiftright("place", 33)
    sizes = held.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy(F.lit(0)).orderBy("part")) - F.col("size")
    offsets = sizes.select("part", before.alias("before"), F.sum("size").over(Window.partitionBy(F.lit(0))).alias("n"))
    placed = held.withColumn("part", part).join(F.broadcast(offsets), "part")  # a row for each partition
    return placed.select(*rows.columns, (F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("at"), "n")


def resampled(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, percent: int = 10, least_words: int = 20, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's (id, n_features, weight, score, rank); rank is null for rows that are not drawn.

    Of the N rows with an id and at least least_words words, floor(percent N / 100) of the highest scores are drawn.
    Null and blank texts have no features and weight 0; rows without an id have no score and are never drawn; rows that
    repeat an id are each a row of its own, and count and rank as such. Extra columns are ignored; an empty table gives
    none, an empty target gives gains against an even spread.
    """
    gains = stored(gain_table(docs, target, n, buckets, text_col), "importance-gains")
    scored = weighed(docs, gains, n, buckets, id_col, text_col)
    scored = stored(scored.withColumn("score", noisy(F.col("weight"), F.col("id"), seed)), "importance-scores")
    able = F.col("id").isNotNull() & (F.col("n_words") >= least_words)
    placed = ranked(scored.where(able).select("id", "n_features", "weight", "score"))
    drawn = placed.select("id", "n_features", "weight", "score", F.when(F.col("at") <= F.expr(f"{percent} * n div 100"), F.col("at")).alias("rank"))
    rest = scored.where(~able).select("id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return drawn.union(rest)


def selected(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs whose id is drawn, all columns as they are; rows that repeat a drawn id come with it."""
    ids = resampled(docs, target, id_col=id_col, **options).where("rank IS NOT NULL").select(F.col("id").alias(id_col)).distinct()
    return docs.join(ids, id_col, "left_semi").select(docs.columns)
