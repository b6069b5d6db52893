"""Document fingerprints: a homomorphic multiset hash of paragraphs, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examlake.llm.common import let, partitions

#: Exact part: LANES sums modulo 2^32 of hashes of whole paragraphs. Near part: NEAR groups of 64 counts modulo 2^16,
#: to which every piece of a paragraph adds one count a group. All as fixed-width hex. A piece ends with a word that
#: ends in one of BORDER, or after PIECE words: content sets its borders, so that a word put in or taken out changes
#: the pieces around it alone.
LANES, NEAR, PIECE, BORDER = 16, 2, 16, "dgkmpr.!?"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
PIECES = rf"(?:[^\x20\x09-\x0D]++(?<![{BORDER}])[\x20\x09\x0B-\x0D]++){{0,{PIECE - 1}}}[^\x20\x09-\x0D]++[\x20\x09\x0B-\x0D]*+"
EXACT_DIGITS, COUNTS = LANES * 8, NEAR * 64


def _hex(x: Column, digits: int) -> Column:
    return F.lower(F.lpad(F.hex(x), digits, "0"))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text (null: empty): paragraphs are its lines, and their order does not count.

    A paragraph's vector is wide: LANES words hashed from its SHA-256, and the counts of its pieces. The fingerprint
    is the sum of the vectors, so equal multisets of paragraphs have equal fingerprints, and combine() adds or takes
    away paragraphs without the rest of the text. An empty text is one empty paragraph.
    """
    text = F.coalesce(text, F.lit(""))
    return let(counts(text), lambda c: F.concat(_exact(text), _digits(c)))


def counts(text: Column) -> Column:
    """The near part as numbers: the counts of a text's pieces by cell."""
    hashes = F.transform(F.regexp_extract_all(text, F.lit(PIECES), F.lit(0)), lambda p: F.xxhash64(p))
    return let(hashes, lambda hs: F.flatten(F.array(*[_cells(hs, 6 * g) for g in range(NEAR)])))


def _exact(text: Column) -> Column:
    return let(F.transform(F.split(text, "\n", -1), lambda p: F.sha2(p, 256)), _sums)


def _digits(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda x: _hex(x, 4)), "")


def _sums(digests: Column) -> Column:
    mask = F.lit(0xFFFFFFFF)
    lane = lambda i: F.aggregate(digests, F.lit(0).cast("long"), lambda a, d: (a + F.xxhash64(d, i).bitwiseAND(mask)).bitwiseAND(mask))
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), lambda i: _hex(lane(i), 8)), "")


def _cells(hashes: Column, shift: int) -> Column:
    """Each piece writes the letter of its cell; counting the letters sums the vectors of counts."""
    letter = lambda h: F.substring(F.lit(ALPHABET), F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(63)).cast("int") + 1, F.lit(1))
    count = lambda line, c: ((F.length(line) - F.length(F.replace(line, c))) % 65536).cast("long")
    letters = F.array(*map(F.lit, ALPHABET))
    return let(F.array_join(F.transform(hashes, letter), ""), lambda line: F.transform(letters, lambda c: count(line, c)))


def _numbers(fp: Column, at: int, digits: int, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.conv(F.substring(fp, F.lit(at + 1) + i * digits, F.lit(digits)), 16, 10).cast("long"))


def combine(a: Column, b: Column, take_away: bool = False) -> Column:
    """The fingerprint of a's paragraphs with b's added, or with b's taken away."""
    parts = []
    for at, digits, n in ((0, 8, LANES), (EXACT_DIGITS, 4, COUNTS)):
        sign = -1 if take_away else 1
        both = F.zip_with(_numbers(a, at, digits, n), _numbers(b, at, digits, n), lambda x, y: _hex(F.pmod(x + sign * y, F.lit(16**digits)), digits))  # noqa: B023
        parts.append(F.array_join(both, ""))
    return F.concat(*parts)


def likeness(a: Column, b: Column) -> Column:
    """How alike two fingerprints are, 0 to 1: 2 x.y / (x.x + y.y) over the centred counts, which estimates the share
    of pieces in common. 1 for equal fingerprints; 0 where nothing is in common."""
    numbers = F.array(*[_numbers(c, EXACT_DIGITS, 4, COUNTS) for c in (a, b)])
    sums = lambda z: F.array(_total(z[0]), _total(z[1]), _dot(z[0], z[1]), _dot(z[0], z[0]), _dot(z[1], z[1]))
    value = let(let(numbers, sums), lambda s: alike(s[2], s[0], s[1], _centred(s[3], s[0], s[0]) + _centred(s[4], s[1], s[1])))
    return F.when(a == b, 1.0).otherwise(value)


def _total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0).cast("long"), lambda s, e: s + e)


def _dot(v: Column, w: Column) -> Column:
    return _total(F.zip_with(v, w, lambda p, q: p * q))


def _centred(xy: Column, n: Column, m: Column) -> Column:
    return xy.cast("double") - n.cast("double") * m.cast("double") / COUNTS


def alike(xy: Column, n: Column, m: Column, norms: Column) -> Column:
    """likeness() from the product of two arrays of counts, their sums, and the sum of their own centred products."""
    share = F.try_divide(2 * _centred(xy, n, m), norms)
    return F.coalesce(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))


def successors(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) in ascending order, the last followed by the first; ids: distinct doc_id.

    Ids alone are range-partitioned; each range finds its successors by itself, and the last of a range takes the
    first of the next from a table with one row per range.
    """
    n = partitions(ids.sparkSession)
    ranged = ids.repartitionByRange(n, "doc_id").withColumn("pid", F.spark_partition_id())
    inner = ranged.withColumn("after", F.lead("doc_id").over(Window.partitionBy("pid").orderBy("doc_id")))
    firsts = ranged.groupBy("pid").agg(F.min("doc_id").alias("first"))
    order = Window.orderBy("pid")
    turn = firsts.select("pid", F.coalesce(F.lead("first").over(order), F.first("first").over(order)).alias("then"))
    return inner.join(F.broadcast(turn), "pid").select("doc_id", F.coalesce("after", "then").alias("next_id"))


def edited(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, text, own, edited_text, next) for docs (doc_id, text); own and next: struct<fp, counts>.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document. Null texts count as empty; rows without an id are left out; rows that repeat an id are each edited with
    the least start of the next id's rows. Extra columns are ignored.
    """
    flat = docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = successors(flat.select("doc_id").distinct())
    half = flat.groupBy("doc_id").agg((F.max(F.length("text")) / 2).cast("int").alias("room"))
    wanted = order.join(half, "doc_id").select(F.col("doc_id").alias("before"), F.col("next_id").alias("doc_id"), "room")
    starts = flat.join(wanted, "doc_id").select("before", F.substring(F.col("text"), F.lit(1), F.col("room")).alias("start"), _both(F.col("text")).alias("next"))
    start = starts.groupBy(F.col("before").alias("doc_id")).agg(F.min(F.struct("start", "next")).alias("s"))
    n, half_n = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    changed = F.concat(F.substring(F.col("text"), F.lit(1), n - half_n), F.substring(F.col("s.start"), F.lit(1), half_n))
    return flat.join(start, "doc_id").select("doc_id", n.cast("long").alias("n_chars"), "text", _both(F.col("text")).alias("own"), changed.alias("edited_text"), F.col("s.next").alias("next"))


def _both(text: Column) -> Column:
    """fp with its counts, their sum n, and their own centred product, so that each is taken once."""
    made = lambda c: F.struct(F.concat(_exact(text), _digits(c)).alias("fp"), c.alias("counts"), _total(c).alias("n"), _dot(c, c).alias("xx"))
    return let(let(counts(text), made), lambda s: s.withField("norm", _centred(s["xx"], s["n"], s["n"])))


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness, and that to the next document.

    Nulls, repeated ids, ties and extra columns as in edited(); a single document is its own next; no rows give none."""
    out = edited(docs).withColumn("changed", _both(F.col("edited_text")))
    col = lambda side, name: F.col(f"{side}.{name}")
    value = lambda o: alike(_dot(col("own", "counts"), col(o, "counts")), col("own", "n"), col(o, "n"), col("own", "norm") + col(o, "norm"))
    near = lambda o: F.when(col("own", "fp") == col(o, "fp"), 1.0).otherwise(value(o))
    return out.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), F.col("own.fp").alias("fingerprint"), F.col("changed.fp").alias("edited_fingerprint"), near("changed").alias("near_edited"), near("next").alias("near_next"))
