"""The pipeline's stages, one after the other, each against brute force over what its predecessor kept."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from test_brute_force import WORD, later_runs
from test_nearcopies import roots

import corpus_pipeline
from examlake.llm import linededup, pieces, quality
from examlake.llm.common import stored, table
from examlake.llm.queries import tokenizer_path

FOLDER = "/root/testdata/sf0.01"


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_in_turn(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    docs = table(spark, FOLDER, "documents")
    columns, names = docs.columns, list(stages)
    kept = stored(stages[names[0]](spark, docs, FOLDER), "p1")
    model = quality.train(docs, table(spark, FOLDER, "labels"))
    before = rows(docs)
    scores = model.score(np.array([quality.features(r["text"]) for r in before.values()], float))
    assert set(rows(kept)) == {i for i, s in zip(before, scores, strict=True) if s >= quality.THRESHOLD} and kept.columns == columns

    cut = stored(stages[names[1]](spark, kept, FOLDER), "p2")
    texts, after = {i: r["text"] or "" for i, r in rows(kept).items()}, rows(cut)
    must = later_runs(texts, linededup.LINE + linededup.WINDOW - 1)
    loose = 2 * (linededup.WINDOW - 1)
    for i, t in texts.items():
        words = WORD.findall(t)
        left = WORD.findall(after[i]["text"] or "") if i in after else []
        if not must[i]:
            continue
        assert len(left) <= len(words) - len(must[i]) + loose * (1 + len(must[i]) // 50)  # repeated passages have gone
    free = later_runs(texts, linededup.SHORT)
    assert all(after[i]["text"] == kept_["text"] for i, kept_ in rows(kept).items() if not free[i])  # and clean texts are as they were
    assert all(r["n_chars"] == len(r["text"]) for r in after.values() if r["text"])

    single = stored(stages[names[2]](spark, cut, FOLDER), "p3")
    ids = sorted(after)
    assert set(rows(single)) == {ids[k] for k, root in enumerate(roots([after[i]["text"] for i in ids])) if root == k}

    mixed = stored(stages[names[3]](spark, single, FOLDER), "p4")
    own, source, taken = {i: Counter(WORD.findall(r["text"] or "")) for i, r in rows(single).items()}, defaultdict(int), defaultdict(int)
    for r in single.collect():
        source[r["source"]] += sum(own[r["doc_id"]].values())
    for r in mixed.collect():
        words = Counter(WORD.findall(r["text"]))
        assert not words - own[r["doc_id"]] and mixed.columns == columns
        taken[r["source"]] += sum(words.values())
    assert abs(sum(taken.values()) - 1.5 * sum(source.values())) <= 64 * len(source) and all(taken[s] <= 2 * source[s] for s in taken)

    sp = pieces.library(tokenizer_path("piece_bpe_32k.model"))
    want = sorted((r["doc_id"], zlib.crc32(np.array(sp.encode(r["text"]), "<u4").tobytes()), len(r["text"])) for r in mixed.collect())
    assert sorted((r["doc_id"], r["ids_crc32"], r["n_chars"]) for r in stages[names[4]](spark, mixed, FOLDER).collect()) == want
    assert re.fullmatch("[a-z ]+sentencepiece[a-z ]*|sentencepiece[a-z ]*", names[4])
