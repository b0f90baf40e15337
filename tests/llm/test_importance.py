"""Importance resampling and the radix sort against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmart.llm import importance, radix

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def runs(text, k=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + n]).encode() for n in range(1, k + 1) for i in range(len(words) - n + 1)]


def brute(docs, targets):
    """``{row number: (doc_id, n_features, weight, score, rank)}``"""
    bucket = lambda f: zlib.crc32(f) % 10_000
    s = Counter(bucket(f) for _, t in docs for f in runs(t)[1])
    t = Counter(bucket(f) for x in targets for f in runs(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    out = {}
    for k, (i, text) in enumerate(docs):
        n_words, own = runs(text)
        weight = sum(math.floor(1000 * math.log((t[bucket(f)] + 1) * (n_s + 10_000) / ((s[bucket(f)] + 1) * (n_t + 10_000)))) for f in own)
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out[k] = [i, n_words, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))]
    order = sorted((k for k in out if out[k][1] >= 20), key=lambda k: (-out[k][4], out[k][0] is None, out[k][0] or 0))
    rank = {k: r for r, k in enumerate(order[: 5 * len(order) // 100], start=1)}
    return Counter((i, n, w, sc, rank.get(k)) for k, (i, _, n, w, sc) in out.items())


def shown(frame):
    return Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in frame.collect())


@given(st.lists(st.binary(max_size=40), max_size=5), st.integers(1, 4))
@settings(max_examples=150, deadline=None)
def test_features_of_any_bytes(docs, run):
    crc, owner, n_words = importance.features(docs, run)
    for i, d in enumerate(docs):
        words = d.translate(importance.ALNUM).split()
        want = Counter(zlib.crc32(b" ".join(words[a : a + n])) for n in range(1, run + 1) for a in range(len(words) - n + 1))
        assert Counter(crc[owner == i].tolist()) == want
        assert n_words[i] == len(words)


def test_resample(spark, docs, corpus, monkeypatch):
    targets = [corpus[1][1], None, "", "Éa kan, KAST!", corpus[4][1]]
    target = spark.createDataFrame([(t, 1) for t in targets], "text string, doc_id int")
    want = brute([(i, t) for i, t, *_ in corpus], targets)
    assert sum(1 for r in want.elements() if r[4]) >= 3
    assert shown(importance.resample(docs, target)) == want


def test_blocks_of_texts_agree(spark, docs, corpus, monkeypatch):
    target = spark.createDataFrame([(corpus[1][1],)], "text string")
    assert shown(importance.resample(docs.repartition(1), target)) == brute([(i, t) for i, t, *_ in corpus], [corpus[1][1]])


def test_resample_of_nothing(spark, none, docs):
    target = spark.createDataFrame([], "text string")
    assert importance.resample(none, target).count() == 0
    assert importance.resample(docs, target).count() == docs.count()


@pytest.mark.parametrize("block", [7, 1 << 17])
@pytest.mark.parametrize("wide", [False, True])
def test_radix_rank(spark, block, wide):
    rng = random.Random(block)
    ends = [-(1 << 63), (1 << 63) - 1, 0, -1] if wide else []
    # A third of all rows share one key, others tie in part; nulls and repeats.
    rows = [(rng.choice([5, 5, rng.randrange(-3000, 3000), None, *ends]), rng.choice([1, rng.randrange(10_000), None, *ends]), i) for i in range(600)]
    rows += [(5, 1, 600 + i) for i in range(300)]
    frame = spark.createDataFrame(rows, "score long, id long, row long").repartition(6)
    got = radix.radix_rank(frame, [("score", True), ("id", False)], bits=5 if not wide else 16, block=block).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, len(rows) + 1))
    assert sorted(r["row"] for r in got) == list(range(len(rows)))
    key = lambda s, i: (s is None, -(s or 0), i is None, i or 0)
    assert [key(r["score"], r["id"]) for r in got] == sorted(key(s, i) for s, i, _ in rows)


def test_radix_rank_of_one_key_and_of_nothing(spark):
    same = spark.range(40).selectExpr("3L AS score", "id")
    assert sorted(r["rank"] for r in radix.radix_rank(same.select("score"), [("score", True)]).collect()) == list(range(1, 41))
    assert radix.radix_rank(same.limit(0), [("score", True), ("id", False)]).count() == 0


def test_crc_of_joined_bytes():
    rng = random.Random(2)
    pairs = [(rng.randbytes(rng.randrange(50)), rng.randbytes(rng.choice([0, 1, 5, 300, 5000]))) for _ in range(200)]
    left = np.array([zlib.crc32(a) for a, _ in pairs], np.uint32)
    right = np.array([zlib.crc32(b) for _, b in pairs], np.uint32)
    joined = importance.crc_joined(left, right, np.array([len(b) for _, b in pairs]))
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_query(spark, sf):
    from docmart.llm.queries import QUERIES

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    targets = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert shown(QUERIES["op12_importance"](spark, sf)) == brute(docs, targets)
