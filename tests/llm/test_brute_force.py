"""The operators against brute force, written from their contracts alone."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from examlake.llm import huffman, linededup, mixing, multiset_hash, pieces, quality, queries, secret_scan
from examlake.llm.common import table
from examlake.llm.queries import tokenizer_path

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
M = 2**64 - 1


def xxh64(data, seed=42):
    p1, p2, p3, p4, p5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
    rot = lambda x, r: ((x << r) | (x >> (64 - r))) & M
    step = lambda acc, lane: rot((acc + lane * p2) & M, 31) * p1 & M
    n, at = len(data), 0
    if n >= 32:
        v = [(seed + p1 + p2) & M, (seed + p2) & M, seed, (seed - p1) & M]
        while at + 32 <= n:
            v = [step(x, int.from_bytes(data[at + 8 * i : at + 8 * i + 8], "little")) for i, x in enumerate(v)]
            at += 32
        h = (rot(v[0], 1) + rot(v[1], 7) + rot(v[2], 12) + rot(v[3], 18)) & M
        for x in v:
            h = ((h ^ step(0, x)) * p1 + p4) & M
    else:
        h = (seed + p5) & M
    h = (h + n) & M
    while at + 8 <= n:
        h = (rot(h ^ step(0, int.from_bytes(data[at : at + 8], "little")), 27) * p1 + p4) & M
        at += 8
    if at + 4 <= n:
        h = (rot(h ^ (int.from_bytes(data[at : at + 4], "little") * p1 & M), 23) * p2 + p3) & M
        at += 4
    for b in data[at:]:
        h = rot(h ^ (b * p5 & M), 11) * p1 & M
    for shift, p in ((33, p2), (29, p3), (32, 1)):
        h = (h ^ (h >> shift)) * p & M
    return h


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, SMALL, "documents").collect()}


def test_simhash(spark, texts):
    def fingerprint(text):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hs = [xxh64(g.encode()) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0

    fps = {i: fingerprint(t) for i, t in texts.items()}
    root = {i: i for i in fps}
    changed = True
    while changed:  # the least id passed along all links until nothing moves
        changed = False
        for i in fps:
            least = min(root[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2)
            changed |= least < root[i]
            root[i] = min(root[i], least)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op1_simhash(spark, SMALL).collect()}
    assert got == {i: (f"{fps[i]:016x}", root[i]) for i in fps}


BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m.group(2)) >= 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 18),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 16),
)


def secrets(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(BASE) for m in p.finditer(text) if ok(m)]
    return [(kind, a, z) for a, _, z, kind in sorted(found)]


def test_secrets(spark, texts):
    for r in queries.op5_secrets(spark, SMALL).collect():
        spans = secrets(texts[r["doc_id"]])
        counts = Counter(k for k, _, _ in spans)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (counts["assign"], counts["access"], counts["hex"])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z in spans).encode()).hexdigest()


def test_secrets_without_recursion(spark):
    key = "-----BEGIN RSA PRIVATE KEY-----"
    hard = ["-----BEGIN PRIVATE KEY-----\n-----BEGIN " + "AB " * 1_000_000 + key, "secret=" + "a" * 2_000_000, "AKIA" + "Z9" * 500_000 + " token = 'é'", key + " é password : 'abcdefghijkl' " + "0" * 17]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(hard)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secret_scan.digest(docs).collect()}
    assert got[0] == "private_key:0:27,private_key:3000039:3000070" and got[1] == "assign:0:2000007,hex:7:2000007" and got[2].startswith("access:0:1000004")
    assert got[3] == f"private_key:0:{len(key)},assign:{len(key) + 3}:{len(key) + 27},hex:{len(key) + 29}:{len(key) + 46}"
    for bad in ("(?:[A-Z]+ )*x", "a(b|c)+", "(x(yz)*)?"):
        with pytest.raises(ValueError):
            secret_scan.Rule("bad", bad)


def test_pieces_equal_the_library(spark):
    path = tokenizer_path("piece_bpe_32k.model")
    sp = pieces.library(path)
    rng = np.random.default_rng(4)
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, MIDDLE, "documents").collect()}
    long_ = ["x" * 61, "ab" * 200, "-" * 500, " " * 130, "Donaudampfschifffahrtsgesellschaft" * 9, "".join(map(chr, rng.integers(97, 123, 900))), "中" * 200, "1" * 90, "naïve" * 30 + "\n" * 80, "=" * 61 + "é" * 70]
    docs |= {-1 - i: t for i, t in enumerate(long_)} | {-100: " ".join(long_)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    for r in pieces.digest(df, path).collect():
        ids = sp.encode(docs[r["doc_id"]])
        text = docs[r["doc_id"]]
        assert (r["n_pieces"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text[:80]
        assert (r["n_chars"], r["text_crc32"]) == (len(text), zlib.crc32(text.encode()))


def test_pieces_in_small_blocks(spark, monkeypatch):
    path = tokenizer_path("piece_bpe_32k.model")
    monkeypatch.setattr(pieces, "BLOCK", 3000)
    monkeypatch.setattr(pieces, "SLICE", 1)
    sp, docs = pieces.library(path), table(spark, SMALL, "documents").repartition(3)
    want = {r["doc_id"]: sp.encode(r["text"] or "") for r in docs.collect()}
    assert {r["id"]: r["ids"] for r in pieces.encoded(docs, path).collect()} == want


def test_likeness_is_the_share_of_pieces(spark, texts):
    part = re.compile(rf"(?:[^\x20\x09-\x0D]+(?<![{multiset_hash.BORDER}])[\x20\x09\x0B-\x0D]+){{0,{multiset_hash.PIECE - 1}}}[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*")
    ids = sorted(texts)
    gaps = []
    for r in multiset_hash.compared(table(spark, SMALL, "documents")).collect():
        t, after = texts[r["doc_id"]], texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = Counter(part.findall(t)), Counter(part.findall(edited))
        if sum(a.values()) >= 30:
            gaps.append(abs(r["near_edited"] - 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values()))))
    assert np.mean(gaps) < 0.08
    base = " ".join(f"w{i % 97}{'m' if i % 5 == 0 else 'x'}" for i in range(300))
    row = spark.range(1).select(*[multiset_hash.fingerprint(F.lit(x)).alias(k) for k, x in (("a", base), ("b", "new " + base), ("c", "other text altogether"))])
    got = row.select(multiset_hash.likeness(F.col("a"), F.col("b")).alias("near"), multiset_hash.likeness(F.col("a"), F.col("c")).alias("far")).first()
    assert got["near"] > 0.9 and got["far"] < 0.2


def test_quality_tables_and_held_out_rows(spark):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = {r["doc_id"]: r for r in quality.classified(docs, labels).collect()}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in got}
    assert all(r["held_out"] == out[i] and r["predicted"] == (r["score"] >= 0.3) for i, r in got.items())
    held = [i for i in known if out[i]]
    assert np.mean([got[i]["predicted"] == known[i] for i in held]) > 0.95
    model = quality.train(docs, labels)
    for r in docs.limit(40).collect():  # the sum of the tables' entries, one by one
        x = quality.features(r["text"])
        bins = [int(np.searchsorted(e, v, side="right")) for e, v in zip(model.edges, x, strict=True)]
        total = model.base + sum(t[b] for t, b in zip(model.tables, bins, strict=True)) + sum(t[bins[i] * quality.PAIR_BINS // quality.BINS, bins[j] * quality.PAIR_BINS // quality.BINS] for i, j, t in model.pairs)
        assert abs(1 / (1 + np.exp(-total)) - got[r["doc_id"]]["score"]) < 1e-9


def test_mixing_word_by_word(spark):
    docs = table(spark, MIDDLE, "documents")
    plan = mixing.Plan(docs)
    sizes = {r["doc_id"]: (r["source"], len(WORD.findall(r["text"] or ""))) for r in docs.collect()}
    by_source = defaultdict(int)
    for s, n in sizes.values():
        by_source[s] += n
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    goal = dict.fromkeys(names, 0.0)
    left, open_ = 1.5 * sum(by_source.values()), list(names)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    while open_:  # the excess of sources over their bound is shared again among the others
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > 2 * by_source[s]]
        for s in over or open_:
            goal[s] = 2.0 * by_source[s] if over else unit * weight[s]
        left -= sum(goal[s] for s in over)
        open_ = [s for s in open_ if s in over] and [s for s in open_ if s not in over]
    got = {r["doc_id"]: r for r in plan.taken().collect()}
    again = {r["doc_id"]: r["taken"] for r in mixing.Plan(docs).taken().collect()}
    slots = Counter((r["sid"], r["block"]) for r in plan.chosen().collect())
    taken = Counter()
    for r in plan.pieces().collect():
        taken[r["doc_id"]] += r["words"] * slots[(r["sid"], r["block"])]
    total = Counter()
    for i, (s, n) in sizes.items():
        r = got[i]
        assert (r["size"], r["source_size"], r["taken"]) == (n, by_source[s], taken[i]) and abs(r["target"] - goal[s]) < 1e-6 * (1 + goal[s]) and r["taken"] <= 2 * n
        total[s] += r["taken"]
    assert all(abs(total[s] - goal[s]) <= mixing.BLOCK_WORDS for s in names) and again == {i: r["taken"] for i, r in got.items()}
    assert max(Counter(r["shard"] for r in plan.chosen().collect()).values()) <= mixing.SHARD_SLOTS


def test_mixing_in_groups():
    slots = [5000, 0, 70000, 31]
    sums = [mixing.draws(slots, g, 4, 1000) for g in range(4)]
    assert [int(sum(s[0][:, k].sum() for s in sums)) for k in range(4)] == slots
    assert all(s[0].sum(1).max() <= 1000 for s in sums) and [int(s[1][2]) for s in sums] == [0, 17500, 35000, 52500]


def later_runs(docs, n):
    """Word ranges of n or more words that also stand at an earlier place, by document and then position."""
    first, out = {}, defaultdict(set)
    for i in sorted(docs):
        w = WORD.findall(docs[i])
        for a in range(len(w) - n + 1):
            key = tuple(w[a : a + n])
            if first.setdefault(key, (i, a)) != (i, a):
                out[i].update(range(a, a + n))
    return out


def test_line_dedup_over_all_pairs(spark):
    rng = np.random.default_rng(8)
    say = lambda n: " ".join(f"v{x}" for x in rng.integers(0, 50_000, n))
    passages, notes = [say(n) for n in (50, 64, 120)], [say(n) for n in (8, 16, 29)]
    docs = {}
    for i in range(240):
        parts = [say(int(rng.integers(5, 60)))]
        if i % 4 == 0:
            parts.append(say(7) + " " + passages[i // 4 % 3] + " " + say(5))
        if i % 3 == 0:
            parts.append("\n" + notes[i // 3 % 3] + "\n")
        parts.append(say(int(rng.integers(1, 30))))
        docs[i] = " ".join(parts)
    docs |= {240: docs[7], 241: "", 242: "short line", 243: "short line"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: {k for s in r["removed"] for k in range(s["start"], s["end"])} for r in linededup.deduplicated(df).collect()}
    runs50, runs8 = later_runs(docs, 50), later_runs(docs, linededup.SHORT)
    short = linededup.SHORT
    seen = set()
    for i in sorted(docs):
        words, at, must = WORD.findall(docs[i]), 0, set()
        for line in docs[i].split("\n"):
            n = len(WORD.findall(line))
            key = tuple(words[at : at + n])
            if n >= short and key in seen:
                must.update(range(at, at + n))
            seen.add(key) if n >= short else None
            at += n
        assert must <= got[i]  # every written line met before has gone
        assert got[i] <= runs8[i]  # and nothing that did not stand anywhere before
        missed = runs50[i] - got[i]
        assert len(missed) <= 2 * (linededup.WINDOW - 1) and (not runs50[i] or got[i] & runs50[i])
    assert got[240] == set(range(len(WORD.findall(docs[7])))) and not got[243]


def test_token_files_of_a_large_vocabulary(spark, tmp_path):
    rng = np.random.default_rng(2)
    ids = {i: rng.integers(0, 90_000, 5000, np.uint32) if i else np.arange(90_000, dtype=np.uint32) for i in range(6)}
    rows = [(i % 3, bytearray(x.astype("<u4").tobytes())) for i, x in ids.items()]  # each id of a document comes twice
    huffman.write(spark.createDataFrame(rows, "id long, ids binary").repartition(3), str(tmp_path / "t"), block_ids=20_000, kind="<u4")
    got = sorted((r["start"], r["id"], bytes(r["ids"])) for r in huffman.read(spark, str(tmp_path / "t")).collect())
    assert sorted((i, x) for _, i, x in got) == sorted((i, bytes(x)) for i, x in rows)
    assert [s for s, _, _ in got] == np.cumsum([0, *(len(x) // 4 for _, _, x in got)]).tolist()[:-1]
    assert huffman.longest_code(np.ones(90_000)) == 18 and huffman.longest_code(np.ones(100)) == huffman.LIMIT
