"""Secret scans through a trigram inverted index, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examlake.llm.common import let

#: Alternatives that a pattern may expand to before a part of it counts as unknown.
WIDEST, CLASS = 256, 4


def _deep(nodes) -> bool:
    """Whether something longer than a character repeats without bound, which the JVM's matcher does by recursion."""
    for op, arg in nodes:
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            _, high, body = arg
            lone = len(body) == 1 and body[0][0] in (sre.LITERAL, sre.NOT_LITERAL, sre.IN, sre.ANY)
            if (high is sre.MAXREPEAT and not lone) or _deep(body):
                return True
        elif op is sre.BRANCH and any(map(_deep, arg[1])) or op is sre.SUBPATTERN and _deep(arg[-1]):
            return True
    return False


@dataclass(frozen=True)
class Rule:
    """Matches of pattern whose group is least characters or longer; base rules give the digest's spans."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False
    base: bool = False

    def __post_init__(self) -> None:
        if _deep(_parser.parse(self.pattern)):
            raise ValueError(f"{self.kind}: a group repeated without bound takes a stack frame each time; use a class")

    @property
    def regex(self) -> str:
        return ("(?i)" if self.any_case else "") + self.pattern


# Where the whole match has a least length, a shorter run cannot hold a longer one, so the length is in the pattern.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18, False, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, False, True),
    Rule("private_key", r"-----BEGIN (?:[A-Z ]* )?PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)

Forms = list[tuple[str, ...]]  # alternatives; each the literal stretches of a match in order, with gaps between


def _forms(nodes) -> Forms:
    out: Forms = [("",)]
    gap: Forms = [("", "")]
    for op, arg in nodes:
        if op is sre.LITERAL:
            part: Forms = [(chr(arg),)]
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= CLASS:
            part = [(chr(a),) for _, a in arg]
        elif op is sre.BRANCH:
            part = [f for branch in arg[1] for f in _forms(branch)]
        elif op is sre.SUBPATTERN:
            part = _forms(arg[-1])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            low, high, body = arg
            once = _forms(body)
            if high == 1:
                part = ([("",)] if low == 0 else []) + once
            else:  # once at least, then anything
                part = gap if low == 0 else [(*f, "") for f in once]
        elif op is sre.AT:
            part = [("",)]
        else:
            part = gap
        if len(out) * len(part) > WIDEST:
            part = gap
        out = [(*a[:-1], a[-1] + b[0], *b[1:]) for a in out for b in part]
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """The Boolean query of a regex: an OR of ANDs of lower-case trigrams that each match has; None if some match
    needs no trigram, so that all texts must be scanned."""
    found = {frozenset(s[i : i + 3].lower() for s in form for i in range(len(s) - 2)) for form in _forms(_parser.parse(pattern))}
    if frozenset() in found:
        return None
    return sorted((c for c in found if not any(o < c for o in found)), key=sorted)


def inverted_index(docs: DataFrame, grams: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (gram, id) of lower-cased texts: of the given trigrams, or of all that occur. Null texts have none."""
    text = F.lower(F.col(text_col))
    if grams is None:
        each = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - 2, F.lit(1))), lambda i: F.substring(text, i, F.lit(3)))
        grams_of = F.filter(F.array_distinct(each), lambda g: F.length(g) == 3)
    else:
        grams_of = let(text, lambda t: F.filter(F.array(*map(F.lit, grams)), lambda g: F.contains(t, g)))
    return docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.explode(grams_of).alias("gram"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(id, kinds) of the documents whose postings satisfy the trigram query of a rule."""
    terms = [F.struct(F.lit(r.kind).alias("kind"), F.lit(c).alias("clause"), F.lit(g).alias("gram"), F.lit(len(clause)).alias("need")) for r in rules for c, clause in enumerate(trigram_query(r.pattern) or []) for g in sorted(clause)]
    table = postings.sparkSession.range(1).select(F.explode(F.array(*terms)).alias("t")).select("t.*")
    met = postings.join(F.broadcast(table), "gram").groupBy("id", "kind", "clause", "need").agg(F.count_distinct("gram").alias("n")).where("n = need")  # the table is as long as the rules
    return met.groupBy("id").agg(F.collect_set("kind").alias("kinds"))


def running_sums(values: Column, width: int = 256) -> Column:
    """Running sums of an array, by groups of width, so that long arrays don't take the square of their length."""
    zero = F.lit(0).cast("long")
    total = lambda v: F.aggregate(v, zero, lambda a, x: a + x)
    groups = lambda v: F.sequence(F.lit(0), F.floor((F.size(v) - 1) / width).cast("int"))

    def within(v: Column, sums: Column, g: Column) -> Column:
        last = F.least(F.lit(width), F.size(v) - g * width)
        return let(total(F.slice(sums, F.lit(1), g)), lambda before: F.transform(F.sequence(F.lit(1), last), lambda j: before + total(F.slice(v, g * width + 1, j))))

    def whole(v: Column) -> Column:
        each = F.transform(groups(v), lambda g: total(F.slice(v, g * width + 1, F.lit(width))))
        return let(each, lambda sums: F.flatten(F.transform(groups(v), lambda g: within(v, sums, g))))

    none = F.array().cast("array<bigint>")
    return F.when(F.size(values) > 0, let(values, whole)).otherwise(none)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs' ids with spans: array<struct<start, rank, end, kind>>, ascending by start, then by the rules' order.

    Code points, end exclusive. Rules with a trigram query are verified on candidates alone, the others on every
    text. Matches are leftmost and do not overlap within a rule; those with too short a group are dropped. Null texts
    have no spans. Rows stay one for one, also where ids repeat or are null; extra columns are ignored.
    """
    indexed = tuple(r for r in rules if trigram_query(r.pattern) is not None)
    flat = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    if indexed:
        grams = sorted({g for r in indexed for c in trigram_query(r.pattern) for g in c})
        found = candidates(inverted_index(flat, grams, "id", "text"), indexed).select(F.col("id").alias("cid"), "kinds")
        flat = flat.join(found, F.col("id").eqNullSafe(F.col("cid")), "left").drop("cid")
    else:
        flat = flat.withColumn("kinds", F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    for r in rules:
        regex = F.lit(r.regex)
        seen = F.col("text").rlike(r.regex)
        if r in indexed:
            seen = F.coalesce(F.array_contains("kinds", r.kind), F.lit(False)) & seen
        flat = flat.withColumn(f"seen_{r.kind}", seen)
        on = F.col(f"seen_{r.kind}")
        flat = flat.withColumn(f"match_{r.kind}", F.when(on, F.regexp_extract_all("text", regex, F.lit(0))).otherwise(none))
        flat = flat.withColumn(f"group_{r.kind}", F.when(on, F.regexp_extract_all("text", regex, F.lit(r.group))).otherwise(none) if r.group else F.col(f"match_{r.kind}"))
        flat = flat.withColumn(f"gap_{r.kind}", F.when(on, F.slice(F.split("text", r.regex, -1), F.lit(1), F.size(f"match_{r.kind}"))).otherwise(none))
        flat = flat.withColumn(f"ends_{r.kind}", running_sums(F.zip_with(f"gap_{r.kind}", f"match_{r.kind}", lambda g, m: (F.length(g) + F.length(m)).cast("long"))))
    parts = [_spans(k, r) for k, r in enumerate(rules)]
    return flat.select(F.col("id").alias(id_col), F.array_sort(reduce(F.concat, parts)).alias("spans"))


def _spans(rank: int, r: Rule) -> Column:
    ends = F.arrays_zip(F.col(f"ends_{r.kind}").alias("e"), F.col(f"match_{r.kind}").alias("m"))
    every = F.zip_with(ends, f"group_{r.kind}", lambda z, g: F.struct(z["e"].alias("e"), F.length(z["m"]).alias("n"), F.length(g).alias("g")))
    kept = F.filter(every, lambda x: x["g"] >= r.least)
    return F.transform(kept, lambda x: F.struct((x["e"] - x["n"]).alias("start"), F.lit(rank).alias("rank"), x["e"].alias("end"), F.lit(r.kind).alias("kind")))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: counts of the base kinds, SHA-256 of their spans, and all spans as text; rows as scan() has them, a null
    or empty text has no spans."""
    base = [r.kind for r in rules if r.base]
    found = scan(docs, rules)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in base], F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
