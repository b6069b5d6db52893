"""Importance resampling, dual-tree clustering and cap filters against brute force and on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from examlake.llm import capfilters, centroids, importance, queries
from examlake.llm.common import table

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VECTORS = "vec_id long, embedding array<double>, dim string, x string, rep int"


def plain_resampling(docs, target, n, buckets=10_000, percent=10, least=20, seed=2024):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        return w, [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    s, t = Counter(b for _, x in docs for b in features(x)[1]), Counter(b for x in target for b in features(x)[1])
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * (sum(s.values()) + buckets)) / ((s[b] + 1) * (sum(t.values()) + buckets))))
    gains = {b: gain(b) for b in range(buckets)}
    out, able = [], []
    for k, (i, x) in enumerate(docs):
        w, f = features(x)
        weight = sum(gains[b] for b in f) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
            if len(w) >= least:
                able.append((-score, i, len(f), k))
        out.append([i, len(f), weight, score, None])
    for rank, (_, _, _, k) in enumerate(sorted(able)[: percent * len(able) // 100], 1):
        out[k][4] = rank
    return sorted(map(repr, out))


@pytest.mark.parametrize("n", [1, 2])
def test_resampling(spark, n):
    docs, target = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    odd = [(None, "no id " * 30), (None, None), (10**6, None), (10**6 + 1, ""), (10**6 + 2, "-- ! \n"), (10**6 + 3, "Tie TIE tie " * 9), (10**6 + 3, "Tie TIE tie " * 9), (10**6 + 4, "É é A a " * 40_000), (10**6 + 4, "another " * 25), (-(2**63), "least " * 21), (2**63 - 1, "greatest " * 19)]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    named = both.select("doc_id", "text", *(F.lit("clash").alias(c) for c in ("id", "h", "pos", "feature", "bucket", "gain", "score", "rank", "part")))
    rows = [tuple(r) for r in both.collect()]
    got = importance.resampled(named, target.withColumn("bucket", F.lit(1)), n=n, percent=30).collect()
    assert sorted(repr([r["id"], r["n_features"], r["weight"], r["score"], r["rank"]]) for r in got) == plain_resampling(rows, [r["text"] for r in target.collect()], n, percent=30)


def test_resampling_of_empty_tables(spark):
    docs, none = table(spark, SMALL, "documents").limit(30), spark.createDataFrame([], "item_id long, text string")
    assert importance.resampled(docs.limit(0), none).count() == 0
    got = importance.resampled(docs, none).collect()
    assert len(got) == 30 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 1 + sum(r["rank"] is not None for r in got)))
    assert importance.selected(docs, none, percent=50).columns == docs.columns


def plain_lloyd(rows, k, rounds, dim, seed):
    good = [(i, v) for i, v in rows if i is not None and v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    whole = [(i, [math.floor(1024 * c) if abs(c) < 1e300 else int(c) * 1024 for c in v]) for i, v in good]
    start = sorted(zip(good, whole, strict=True), key=lambda p: (hashlib.sha256(f"{seed}:{p[0][0]}".encode()).hexdigest(), p[0][1]))[:k]
    at = [w for _, (_, w) in start]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda: [min(range(len(at)), key=lambda j: (far(v, at[j]), j)) for _, v in whole]
    for _ in range(rounds):
        members = defaultdict(list)
        for (_, v), j in zip(whole, near(), strict=True):
            members[j].append(v)
        at = [[sum(c) // len(members[j]) for c in zip(*members[j], strict=True)] if members[j] else at[j] for j in range(len(at))]
    hold = lambda x: min(x, 2**63 - 1)
    found = [(i, j, far(v, at[j])) for (i, v), j in zip(whole, near(), strict=True)]
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += hold(d)
    return sorted((i, j, hold(d), hold(inertia[j]), hold(sum(inertia.values())), hashlib.sha256(",".join(map(str, at[j])).encode()).hexdigest()) for i, j, d in found)


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "clash", "clash", 1) for i, v in rows], VECTORS).repartition(parts)


def grouped(n, dim, groups, spread, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(groups, dim))
    return (base[rng.integers(0, groups, n)] + rng.normal(0, spread, (n, dim))).tolist()


ODD = [(1, None), (2, [float("nan")] * 4), (3, [1.0, None, 1.0, 1.0]), (4, [float("inf"), 0.0, 0.0, 0.0]), (5, [1.0, 2.0]), (None, [1.0, 2.0, 3.0, 4.0]), (6, []), (7, [0.0] * 4)]


@pytest.mark.parametrize(("n", "groups", "spread", "k"), [(400, 9, 0.02, 5), (300, 300, 0.5, 20), (5, 2, 0.1, 8)])
def test_clusters(spark, monkeypatch, n, groups, spread, k):
    monkeypatch.setattr(centroids, "BLOCK", 64)
    rows = [(i % (n - 2) + 100, v) for i, v in enumerate(grouped(n, 4, groups, spread, k))] + ODD
    rows += [(1000 + i, rows[0][1]) for i in range(40)]
    got = centroids.cluster(vectors(spark, rows), k=k, rounds=4, dim=4)
    assert sorted(map(tuple, got.collect())) == plain_lloyd(rows, k, 4, 4, 3)


def test_clusters_of_huge_components(spark):
    rows = [(i, [1e30 * (i % 3), -1e12 * i, float(i), 0.25]) for i in range(30)] + [(50, [1e305, 1.0, 1.0, 1.0]), (51, [-1.7e308, 1.7e308, 0.0, 0.0])]
    got = centroids.cluster(vectors(spark, rows), k=4, rounds=3, dim=4)
    assert sorted(map(tuple, got.collect())) == plain_lloyd(rows, 4, 3, 4, 3)
    assert centroids.cluster(vectors(spark, rows).limit(0)).count() == 0
    assert centroids.cluster(vectors(spark, ODD), dim=9).count() == 0


def test_trees_cover_and_search_is_exact():
    rng = np.random.default_rng(5)
    for n, d, k, spread in ((1500, 3, 40, 20), (1200, 64, 8, 5), (400, 2, 200, 1), (300, 64, 8, 900), (1, 3, 1, 1)):
        v = (rng.integers(-1000, 1000, (12, d))[rng.integers(0, 12, n)] + rng.normal(0, spread, (n, d))).astype(np.int64)
        v[: n // 10] = v[0]
        tree, c = centroids.cover_tree(v), v[rng.integers(0, n, k)]
        assert sorted(tree["order"].tolist()) == list(range(n))
        for i in range(len(tree["start"])):
            own = v[tree["order"][tree["start"][i] : tree["end"][i]]]
            assert np.sqrt(((own - v[tree["centre"][i]]) ** 2).sum(axis=1)).max() <= tree["radius"][i] * (1 + 1e-12)
        got = np.full(n, -1)
        for at, j in centroids.nearest(tree, v, v.astype(float), c, centroids.cover_tree(c, 1)):
            assert (got[at] == -1).all()
            got[at] = j
        assert (got == centroids.squared(v, c).argmin(axis=1)).all()


def plain_links(rows, cosine):
    fine = [v is not None and i is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v) for i, v in rows]
    unit = [capfilters.units([np.array(v)])[0] if f else None for (_, v), f in zip(rows, fine, strict=True)]
    near = [[b for b in range(len(rows)) if b != a and fine[a] and fine[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine] for a in range(len(rows))]
    out = []
    for a, (i, _) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        least = min(rows[b][0] for b in seen) if i is not None else None
        out.append((i, len(near[a]), least, i is not None and i == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("dim", [1, 2, 4, 16, 64])
def test_cap_filters(spark, dim):
    rows = [(i // 2 * 2 if i < 20 else i, v) for i, v in enumerate(grouped(260, dim, 60, 0.12, dim))]
    rows += [(1000 + i, rows[5][1]) for i in range(30)] + [(2000 + i, (np.array(rows[5][1]) * 3).tolist()) for i in range(5)] + [(3000, (-np.array(rows[5][1])).tolist())] + ODD
    rows += [(4000, [1e300] * dim), (4001, [1e-300] * dim), (4002, [5e-324] * dim)]
    got = sorted(map(tuple, capfilters.near_duplicates(vectors(spark, rows)).collect()), key=repr)
    want = plain_links(rows, 0.95)
    # Nothing that is no link; of the links, those that share no filter may be missing.
    assert [r[0] for r in got] == [r[0] for r in want] and all(a[1] <= b[1] for a, b in zip(got, want, strict=True))
    assert sum(r[1] for r in got) >= 0.995 * sum(r[1] for r in want) and sum(a == b for a, b in zip(got, want, strict=True)) >= 0.98 * len(want)


def test_cap_filters_in_parts_and_empty(spark, monkeypatch):
    monkeypatch.setattr(capfilters, "PART", 16)
    rows = [(i, v) for i, v in enumerate(grouped(300, 24, 3, 0.1, 3))]
    got = sorted(map(tuple, capfilters.near_duplicates(vectors(spark, rows, 5)).collect()), key=repr)
    want = plain_links(rows, 0.95)
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True)) and sum(r[1] for r in got) >= 0.995 * sum(r[1] for r in want)
    assert [r[2:] for r in got] == [r[2:] for r in want] and max(r[1] for r in got) > 60
    assert capfilters.near_duplicates(vectors(spark, rows).limit(0)).count() == 0
    assert len(capfilters.keep_one(vectors(spark, rows)).collect()) == sum(r[3] for r in got)


@pytest.mark.parametrize("dim", [16, 64, 384])
def test_recall_at_the_threshold(dim):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(1000, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    e = rng.normal(size=x.shape)
    e -= (e * x).sum(axis=1)[:, None] * x
    y = 0.95001 * x + math.sqrt(1 - 0.95001**2) * e / np.linalg.norm(e, axis=1)[:, None]
    code = capfilters.code_for(dim, 50_000, 0.95)
    sets = [defaultdict(set), defaultdict(set)]
    for s, v in zip(sets, (x, y), strict=True):
        for a, f in zip(*code.filters(v), strict=True):
            s[int(a)].add(int(f))
    assert np.mean([bool(sets[0][i] & sets[1][i]) for i in range(len(x))]) > 0.99


def test_decoding_lists_all_filters():
    code = capfilters.code_for(16, 5000, 0.95)
    unit = capfilters.units(list(np.random.default_rng(1).normal(size=(9, 16))))
    want = set()
    for i, (p, q) in enumerate(code.parts):
        whole = (unit @ p)[:, :, None] + (unit @ q)[:, None, :]
        want |= {(a, i * code.size**2 + b * code.size + c) for a, b, c in zip(*(x.tolist() for x in np.nonzero(whole >= code.alpha)), strict=True)}
    assert set(zip(*(x.tolist() for x in code.filters(unit)), strict=True)) == want


def test_queries_are_registered():
    assert {"op11_importance", "op12_centroids", "op13_cap_filters"} <= set(queries.QUERIES) and {"op11_importance", "op12_centroids"} <= set(queries.ORACLE_SQL)
