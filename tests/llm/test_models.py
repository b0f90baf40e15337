"""Scores, languages, mixtures, test phrases and tool calls."""

from __future__ import annotations

import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docmart.llm import chat_tools, fm_index, langid, lm_score, mixing, toxicity
from tests.llm.conftest import make_docs, sentence

# ---- FM-index ----------------------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items, window):
    words, gone, named = words_of(text), set(), set()
    for item, own in items:
        w = words_of(own)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrase = w[i : i + window]
            for p in range(len(words) - len(phrase) + 1):
                if words[p : p + len(phrase)] == phrase:
                    gone |= set(range(p, p + len(phrase)))
                    named |= {item} - {None}
    return len(words), gone, sorted(named)


@pytest.mark.parametrize(("window", "block"), [(10, 32 << 20), (3, 100)])
def test_occurrences(spark, docs, corpus, monkeypatch, window, block):
    monkeypatch.setattr(fm_index, "BLOCK_BYTES", block)
    long = corpus[85][1].split(" ")
    items = [(7, " ".join(long[100:125]).upper()), (8, corpus[1][1]), (8, "éa"), (9, "no such words here at all"), (10, None), (11, " - "), (None, corpus[5][1]), (12, "kan")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, data string")
    want = Counter()
    for i, t, *_ in corpus:
        n, gone, named = brute_hits(t, items, window)
        runs = []
        for p in sorted(gone):
            if runs and runs[-1][1] == p:
                runs[-1][1] = p + 1
            else:
                runs.append([p, p + 1])
        want[(i, n, tuple(map(tuple, runs)), tuple(named))] += 1
    found = fm_index.find(docs, bench, window).collect()
    assert Counter((r[0], r[1], tuple(map(tuple, r[2])), tuple(r[3])) for r in found) == want


@pytest.mark.parametrize("block", [32 << 20, 60])
def test_clean(spark, docs, corpus, none, monkeypatch, block):
    monkeypatch.setattr(fm_index, "BLOCK_BYTES", block)
    long = corpus[85][1].split(" ")
    items = [(7, " ".join(long[100:125])), (8, "éa"), (None, corpus[5][1]), (None, corpus[6][1]), (10, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter((i, t) for i, t, *_ in corpus if not brute_hits(t, items, 10)[1])
    left = fm_index.clean(docs, bench)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == want
    assert len(want) < len(corpus) - 4
    assert fm_index.clean(none, bench).count() == 0
    assert fm_index.clean(docs, bench.limit(0)).count() == len(corpus)


def test_no_documents_or_no_items(spark, docs, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert fm_index.find(none, bench).count() == 0
    assert fm_index.find(docs, bench).where("size(spans) > 0").count() == 0


@given(st.lists(st.lists(st.integers(2, 5), min_size=1, max_size=12), min_size=1, max_size=6), st.lists(st.integers(2, 5), min_size=1, max_size=4))
@settings(max_examples=80, deadline=None)
def test_search_finds_every_place(stretches, phrase):
    text = np.array([s for part in stretches for s in [*part, fm_index.GAP]] + [fm_index.END])
    index = fm_index.FMIndex(text, 5)
    low, high = index.search(np.array([[0] * (4 - len(phrase)) + phrase]))
    places = index.locate(np.arange(low[0], high[0])) if high[0] > low[0] else []
    n = len(phrase)
    assert sorted(places) == [p for p in range(len(text) - n + 1) if text[p : p + n].tolist() == phrase]


# ---- languages ---------------------------------------------------------------


def test_languages(spark):
    rng = random.Random(1)
    vocab = {"aa": ["kala", "muna", "silo", "tavi"], "bb": ["brecht", "schlom", "krauft", "zwolg"], "ru": ["мова", "слово", "речь"]}
    rows = [(i, sentence(rng, 30, vocab[lang]), lang, "s") for i in range(120) for lang in [list(vocab)[i % 3]]]
    rows += [(200, None, "aa", "s"), (201, "", "aa", "s"), (202, "12 ... 34", "bb", "s"), (203, sentence(rng, 40, vocab["aa"]), None, "s"), (None, sentence(rng, 40, vocab["bb"]), "aa", "s")]
    mixed = sentence(rng, 12, vocab["aa"]) + ". " + sentence(rng, 30, vocab["bb"]) + " " + sentence(rng, 9, vocab["ru"])
    rows += [(204, mixed, None, "s"), (205, "kala " * 30_000, None, "s"), (205, "kala " * 30_000, None, "s"), (206, "ΑΒΓ δεζ", None, "s")]
    docs = make_docs(spark, rows)
    model = langid.train(docs)
    assert model.langs == ["aa", "bb", "ru"]
    found = defaultdict(list)
    for r in langid.identify(docs, model).collect():
        found[r.doc_id].append(r)
    assert all(found[i][0].lang_pred == list(vocab)[i % 3] and found[i][0].score == 1.0 for i in range(120))
    assert [found[i][0].lang_pred for i in (200, 201, 202, 203)] == ["und", "und", "und", "aa"] and found[200][0].score == 0
    assert [(s.start, s.end, s.lang) for s in found[204][0].spans] == [(0, 12, "aa"), (12, 42, "bb"), (42, 51, "ru")]
    assert found[204][0].lang_pred == "bb" and 0 < found[204][0].score < 1
    assert [r.lang_pred for r in found[205]] == ["aa", "aa"]
    assert found[206][0].lang_pred == "aa"  # no candidate in its script: a tie
    assert found[None][0].lang_pred == "bb"
    untaught = langid.train(docs.where("lang is null"))
    assert {r.lang_pred for r in langid.identify(docs, untaught).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


@given(st.lists(st.integers(0, 6), min_size=1, max_size=6), st.integers(0, 10_000))
@settings(max_examples=40, deadline=None)
def test_viterbi_is_the_best_path(sizes, seed):
    scores = np.random.default_rng(seed).normal(size=(sum(sizes), 3)).astype(np.float32) * 3
    path = langid.viterbi(scores, np.array(sizes), 2.0)

    def value(p, s):
        return sum(s[t, x] for t, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:], strict=False))

    at = 0
    for n in sizes:
        own = scores[at : at + n]
        every = [[]]
        for _ in range(n):
            every = [[*p, x] for p in every for x in range(3)]
        assert n == 0 or math.isclose(value(path[at : at + n].tolist(), own), max(value(p, own) for p in every), abs_tol=1e-3)
        at += n


# ---- language models ---------------------------------------------------------


def test_cross_entropy_difference(spark, docs, corpus, none):
    size = 12
    targets = spark.createDataFrame([(i, "x") for i in (1, 2, 3, 85, None)], "doc_id long, target string")

    def split(t):
        return [w.encode() for w in words_of(t)]

    count = Counter(w for _, t, *_ in corpus for w in split(t))
    top = [w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))[: size - 2]]
    index = {w: i for i, w in enumerate(top, 2)}
    single, pairs = np.zeros((2, size)), np.zeros((2, size, size))
    for i, t, *_ in corpus:
        ids = [index.get(w, 0) for w in split(t)]
        for m in [0, 1] if i in (1, 2, 3, 85) else [0]:
            for a, b in zip([1, *ids], ids, strict=False):
                single[m, b] += 1
                pairs[m, a, b] += 1

    def p(m, a, b):
        low = (single[m, b] + 1) / (single[m].sum() + size)
        seen = pairs[m, a].sum()
        return 0.7 * pairs[m, a, b] / seen + 0.3 * low if seen else low

    want = Counter()
    for i, t, *_ in corpus:
        ids = [index.get(w, 0) for w in split(t)]
        loss = [math.log(p(0, a, b)) - math.log(p(1, a, b)) for a, b in zip([1, *ids], ids, strict=False)]
        want[(i, len(ids), round(sum(loss) / len(loss), 4) + 0.0 if loss else 0.0)] += 1
    found = lm_score.score(docs, targets, vocabulary=size).collect()
    assert Counter((r[0], r[1], round(r[2], 4) + 0.0) for r in found) == want
    assert lm_score.score(none, targets, vocabulary=size).count() == 0
    assert lm_score.score(docs, targets.limit(0), vocabulary=size).count() == len(corpus)


# ---- mixtures ----------------------------------------------------------------


def exact_weights(tokens, a):
    z = sum(t**a for t in tokens.values())
    return {s: t**a / z for s, t in tokens.items()}


@pytest.mark.parametrize(("share", "repeats", "budget"), [(0.9, None, None), (None, 2.0, None), (0.99, 1.5, 3000), (None, None, 40_000), (1.0, None, 500)])
def test_mixture(docs, corpus, share, repeats, budget):
    sizes = mixing.token_counts(docs)
    tokens = Counter()
    for _, t, _, s in corpus:
        tokens[s] += len((t or "").encode().split())
    assert {r.source: r.n for r in sizes.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()} == tokens
    whole = budget if budget is not None else sum(tokens.values())
    plan = {r.source: r for r in mixing.weights(sizes, budget, share, repeats).collect()}
    filled = {s: n for s, n in tokens.items() if n}
    a = next(iter(plan.values())).exponent
    want = exact_weights(filled, a)
    assert all(math.isclose(plan[s].weight, want[s], rel_tol=1e-9) for s in filled)

    def entropy(x):
        return -sum(w * math.log(w) for w in exact_weights(filled, x).values() if w)

    def most(x):
        return max(w * whole / filled[s] for s, w in exact_weights(filled, x).items())

    if repeats is not None and most(1.0) <= repeats:
        assert most(a) <= repeats + 1e-6
    if share is not None and (repeats is None or most(a) < repeats - 1e-3):
        assert entropy(a) >= share * math.log(len(filled)) - 1e-9
        assert a == 1 or entropy(a + 1e-6) <= share * math.log(len(filled)) + 1e-6
    placed = mixing.mix(sizes, budget, share, repeats, block_tokens=300).collect()
    got, longest = Counter(), max(len((t or "").split()) for _, t, *_ in corpus)
    for r in placed:
        got[r.source] += r.n_tokens
    for s in filled:
        assert plan[s].budget - longest <= got[s] <= plan[s].budget
    per_doc = Counter((r.source, r.doc_id, r.n_tokens, r["pass"]) for r in placed)
    rows = Counter((s, i, len((t or "").encode().split())) for i, t, _, s in corpus)
    assert all(n <= rows[k[:3]] for k, n in per_doc.items())
    passes = defaultdict(set)
    for r in placed:
        passes[r.source].add(r["pass"])
    for s, own in passes.items():
        assert own == set(range(max(own) + 1))
        for p in range(max(own)):  # whole passes hold every row of the source
            assert sum(n for k, n in per_doc.items() if k[0] == s and k[3] == p) == sum(n for k, n in rows.items() if k[0] == s)


def test_mixture_of_nothing(none):
    assert mixing.mix(mixing.token_counts(none)).count() == 0


# ---- toxicity ----------------------------------------------------------------


def toxic_set(spark, n=700):
    rng = random.Random(5)
    words = [a + b for a in "bdfgklmn" for b in ("aro", "eli", "omu", "uta", "ani")]
    rows, labels = [], []
    for i in range(n):
        parts = [sentence(rng, 8, words) for _ in range(rng.randint(1, 12))]
        bad = i % 6 == 0
        if bad:
            k = rng.randrange(len(parts))
            parts[k] += " " + rng.choice(["vexor", "grumbix", "vexorine"])
        rows.append((i, ". ".join(parts) + ".", "xx", "s"))
        labels.append((i, 1, int(bad)))
    return make_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_toxicity_held_out_and_located(spark):
    docs, labels, rows = toxic_set(spark)
    model = toxicity.train(docs, labels)
    more = make_docs(spark, [(5000, None, None, None), (5001, "", None, None), (None, "vexor.", None, None), (5002, "aro. " * 20_000, None, None), (5003, "Fine words. You VEXOR!\nbye", None, None)])
    found = {r.doc_id: r for r in toxicity.score(docs.union(more), model).collect()}
    held = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum((found[i].score >= toxicity.THRESHOLD) == (i % 6 == 0) for i in held)
    assert right / len(held) > 0.97
    assert found[5000].score == found[5001].score < 0.3
    assert found[5002].score < 0.3 <= found[None].score
    assert [(s.sentence, s.text) for s in found[5003].offending] == [(1, " You VEXOR")]
    assert all(0 <= r.score <= 1 for r in found.values())


def test_noisy_or_against_brute_force(spark):
    docs, labels, rows = toxic_set(spark, 200)
    model = toxicity.train(docs, labels)
    assert model.weights and 0 < model.leak < 1
    found = {r.doc_id: r for r in toxicity.score(docs, model, threshold=0.0).collect()}
    for i, text, *_ in rows:
        calm, own = 1 - model.leak, []
        for k, part in enumerate(s for s in re.split(r"[.!?\n]", text) if s.strip()):
            words = set(re.findall(r"[a-z]+", part.lower()))
            hits = [model.weights[w] for w in words | {w[:4] + "-" for w in words} | {w[:5] + "-" for w in words} if w in model.weights]
            if hits:
                own.append((k, 1 / (1 + math.exp(-(toxicity.BIAS + sum(hits))))))
                calm *= 1 - own[-1][1]
        assert math.isclose(found[i].score, 1 - calm, abs_tol=1e-9)
        assert [k for k, _ in own] == [s.sentence for s in found[i].offending]
        assert np.allclose([p for _, p in own], [s.score for s in found[i].offending], atol=1e-9)


def test_fit_raises_the_likelihood_of_the_labels():
    rng = np.random.default_rng(4)
    bags = [[rng.choice(6, rng.integers(1, 4), replace=False).tolist() for _ in range(rng.integers(0, 5))] for _ in range(150)]
    # Some labels are wrong, so that the likelihood has a maximum.
    label = [int(any(0 in s or {1, 2} <= set(s) for s in b)) ^ int(rng.random() < 0.1) for b in bags]

    def likelihood(theta):
        total = 0.0
        for b, y in zip(bags, label, strict=True):
            calm = 1 - 1 / (1 + math.exp(-theta[-1]))
            for s in b:
                calm *= 1 - 1 / (1 + math.exp(-(toxicity.BIAS + sum(theta[w] for w in s))))
            total += math.log(max(1e-12, 1 - calm if y else calm))
        return total

    start = np.full(6, 3.0)
    theta = toxicity.fit(pd.DataFrame({"toxic": label, "words": bags}), start)
    best = likelihood(theta)
    assert best > likelihood(np.append(start, -3.0)) + 20
    for k in range(7):
        for step in (-1.0, 1.0):
            near = theta.copy()
            near[k] += step
            assert likelihood(near) < best + 0.5


def test_toxicity_without_labels(spark, docs, none):
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, labels) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(none, None).count() == 0
    one = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (3, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, one)
    assert model is None or max(r.score for r in toxicity.score(docs, model).collect()) < 0.3


# ---- tool calls --------------------------------------------------------------

SCHEMAS = {
    "add": {"type": "object", "properties": {"a": {"type": "integer", "minimum": 0, "maximum": 9}, "b": {"type": "number"}}, "required": ["a"], "additionalProperties": False},
    "list": {"type": "object", "properties": {"x": {"type": "array", "items": {"type": "string", "minLength": 1}}, "m": {"enum": ["p", "q"]}}},
}
CALLS = "conv_id long, seq long, call_id string, name string, arguments string, depends_on array<string>, level string, content string"


def test_tool_calls(spark):
    calls = [
        (1, 3, "c", "add", '{"b": 1.5, "a": 2}', ["b", "a", "a", None]),
        (1, 1, "a", "add", '{"a": 10, "z": true}', None),
        (1, 2, "b", "list", '{"x": ["é\\u0041", ""], "m": "r"}', ["a"]),
        (1, 2, "b", "list", '{"x": []}', ["a"]),
        (1, 9, "d", "none", "{}", ["gone"]),
        (1, 5, "x", "add", "not json", ["y"]),
        (1, 6, "y", "add", None, ["x"]),
        (1, 7, "z", "add", '{"a": true}', ["y"]),
        (2, 1, "a", "add", "[1]", []),
        (None, 1, "a", "add", "{}", []),
        (2, 1, None, "add", "{}", []),
        (3, 1, "n", "add", '{"a": NaN}', ["n"]),
    ] + [(4, i, f"k{i}", "list", "{}", [f"k{i - 1}"] if i else []) for i in range(12)]
    results = [(1, "a", "two"), (1, "a", "one"), (1, "lost", None), (2, "b", 'q"'), (1, "c", None), (None, "a", "x")]
    frame = spark.createDataFrame([(*c, "l", "c") for c in calls], CALLS)
    found = {(r.conv_id, r.call_id): r for r in chat_tools.link(frame, spark.createDataFrame(results, "conv_id long, call_id string, content string"), SCHEMAS).collect()}
    assert len(found) == 23
    status = {k: r.status for k, r in found.items()}
    assert [status[1, k] for k in ("a", "b", "c", "d", "x", "y", "z", "lost")] == ["linked", "pending", "linked", "pending", "cyclic", "cyclic", "cyclic", "orphan"]
    assert status[2, "b"] == "orphan" and status[2, "a"] == "pending" and status[3, "n"] == "cyclic"
    assert [found[1, k].level for k in "abcdx"] == [0, 1, 2, 0, None]
    assert [found[4, f"k{i}"].level for i in range(12)] == list(range(12))
    assert found[1, "d"].missing == ["gone"] and found[1, "c"].missing == []
    assert found[1, "a"].errors == ["$.a: above maximum", "$.z: unknown"]
    assert found[1, "c"].valid and found[1, "c"].errors == []
    assert found[1, "d"].errors == ["$: no schema"] and found[1, "x"].errors == ["$: not JSON"] and found[2, "a"].errors == ["$: not of type object"]
    assert found[1, "z"].errors == ["$.a: not of type integer"] and found[3, "n"].errors == ["$: not JSON"]
    assert found[1, "b"].n_calls == 2 and found[1, "a"].n_results == 2
    assert found[1, "c"].json == '{"arguments":{"a":2,"b":1.5},"depends_on":["a","b"],"id":"c","level":2,"name":"add","result":null}'
    assert json.loads(found[1, "a"].json)["result"] == "one"
    for r in found.values():
        assert r.json == chat_tools.canonical(json.loads(r.json))


@pytest.mark.parametrize("seed", [1, 2])
def test_levels_of_any_graph(spark, seed):
    """Chains, joins, cycles and what is behind them, unknown calls; levels by plain recursion."""
    rng = random.Random(seed)
    needs = {}
    for conv in range(6):
        for i in range(40):
            if rng.random() < 0.7:
                deps = [f"k{i - 1}"] if i else []
            else:
                deps = [f"k{rng.randrange(45)}" for _ in range(rng.randrange(4))] if conv < 3 else [f"k{rng.randrange(i)}" for _ in range(rng.randrange(4)) if i]
            needs[conv, f"k{i}"] = set(deps)
    want = {}
    while True:
        new = {}
        for (conv, call), deps in needs.items():
            inner = [d for d in deps if (conv, d) in needs]
            if (conv, call) not in want and all((conv, d) in want for d in inner):
                new[conv, call] = max((want[conv, d] + 1 for d in inner), default=0)
        if not new:
            break
        want |= new
    calls = spark.createDataFrame([(c, k, sorted(d)) for (c, k), d in needs.items()], "conv_id long, call_id string, depends_on array<string>")
    got = {(r["conv_id"], r["call_id"]): r for r in chat_tools.levels(calls).collect()}
    assert {k: r["level"] for k, r in got.items()} == {k: want.get(k) for k in needs}
    assert {k: r["missing"] for k, r in got.items()} == {k: sorted(d for d in v if (k[0], d) not in needs) for k, v in needs.items()}
    assert 20 < len(want) < len(needs)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    seen = []
    staged = chat_tools.stage
    monkeypatch.setattr(chat_tools, "stage", lambda df, label: seen.append(label) or staged(df, label))
    calls = spark.range(3000).selectExpr("1L AS conv_id", "concat('k', id) AS call_id", "IF(id > 0, array(concat('k', id - 1)), array()) AS depends_on")
    got = {int(r["call_id"][1:]): r["level"] for r in chat_tools.levels(calls).collect()}
    assert got == {i: i for i in range(3000)}
    assert seen.count("jumps") <= 15 and seen.count("levels") == 1


def test_no_tool_calls(spark):
    empty = spark.createDataFrame([], CALLS)
    assert chat_tools.link(empty, spark.createDataFrame([], "conv_id long, call_id string, content string"), {}).count() == 0


@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(), x, max_size=4), max_leaves=12))
@settings(max_examples=80, deadline=None)
def test_canonical_json_is_stable(value):
    line = chat_tools.canonical(value)
    assert json.loads(line) == value and chat_tools.canonical(json.loads(line)) == line
