"""Every stage of the pipeline, and all of them, against brute force on planted documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest
from test_dedup import brute_components, brute_fingerprint

import corpus_pipeline
from docmart.llm import fm_index, mixing, toxicity

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars", "fp", "data", "found", "edges", "target", "kept", "toxic", "u", "v", "n_tokens")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def make_docs(spark, rows):
    """``documents`` with further columns, whose names operators use inside."""
    full = [(*r[:4], None if r[1] is None else len(r[1]), 1, "x", "y", 2, "z", "k", "t", 3, 4, "n") for r in rows]
    types = "long string string string long long string string int string string string int int string".split()
    return spark.createDataFrame(full, ", ".join(f"{c} {t}" for c, t in zip(COLUMNS, types, strict=True)))


def words(rng, n, start="w"):
    return [f"{start}{rng.randrange(4000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def planted():
    """Clean documents; toxic ones; exact and near copies; passages of test items; one id with two
    texts; rows without an id, without a text, empty ones, a very long one, repeated rows."""
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, 30, "q"))) for i in range(6)] + [(6, None), (7, "")]
    rows, labels = [], []
    for i in range(160):
        text = ". ".join(" ".join(words(rng, 12)) for _ in range(rng.randint(2, 6)))
        if i % 5 == 0:
            text += ". you vile " + rng.choice(["scum", "filth"]) + " " + " ".join(words(rng, 5))
        labels.append((i, 1, int(i % 5 == 0)))
        rows.append([i, text, "xx", f"s{i % 3}"])
    rows += [[200 + i, rows[i][1], "yy", "s0"] for i in range(1, 30)]  # exact copies
    for i in range(31, 50):  # near copies
        parts = rows[i][1].split(" ")
        parts[-1] = "z"
        rows.append([300 + i, " ".join(parts), "xx", "s1"])
    for i in range(51, 60):  # passages
        rows[i][1] += " " + " ".join(items[i % 6][1].split(" ")[5:20])
    rows += [[400, None, None, None], [401, "", "xx", "s0"], [402, " \n", "xx", "s0"], [403, " ".join(words(rng, 12_000)), "xx", "s2"]]
    rows += [[None, rows[61][1], "xx", "s0"], [None, "alone without an id", None, None], [None, None, None, None]]
    rows += [[62, "another text under an id that is there already", "xx", "s0"], rows[63], rows[63], [64, rows[65][1], "xx", "s0"]]
    return [tuple(r) for r in rows], items, labels


@pytest.fixture(scope="module")
def sf(planted, tmp_path_factory):
    rows, items, labels = planted
    path = tmp_path_factory.mktemp("pipeline")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [(*r, None if r[1] is None else len(r[1])) for r in rows])
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    for name in ("documents", "benchmark", "labels"):
        con.execute(f"COPY {name} TO '{Path(path) / name}.parquet'")
    return str(path)


def kept_rows(frame):
    assert frame.columns[:4] == ["doc_id", "text", "lang", "source"]
    return Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in frame.collect())


def model_of(spark, rows, sf):
    return toxicity.train(make_docs(spark, rows), spark.read.parquet(f"{sf}/labels.parquet"))


def brute_toxic(model, text):
    """Leaky noisy-or, sentence by sentence."""
    calm = 1 - model.leak
    for sentence in re.split(r"[.!?\n]+", text or ""):
        found = set(re.findall(r"[^\W\d_]+", sentence.lower()))
        found |= {w[:k] + "-" for w in set(found) for k in (4, 5)}
        weights = [model.weights[w] for w in found if w in model.weights]
        if weights:
            calm *= 1 - 1 / (1 + math.exp(-max(-30.0, min(30.0, toxicity.BIAS + sum(weights)))))
    return 1 - calm


def brute_exact(rows):
    best = {}
    for r in rows:
        own = (r[0] is not None, r[0] or 0)
        if (r[1] or "") not in best or own > best[r[1] or ""][0]:
            best[r[1] or ""] = (own, r)
    return [r for _, r in best.values()]


def brute_near(rows):
    ids = defaultdict(list)
    for r in rows:
        ids[brute_fingerprint(r[1], 4)].append(r[0])
    name = brute_components(ids, 4)
    kept, without = [], defaultdict(list)
    for r in rows:
        component = name[brute_fingerprint(r[1], 4)]
        if component is None:
            without[frozenset(p for p in ids if name[p] is None)].append(r)
        elif r[0] == component:
            kept.append(r)
    assert not any(len(v) > 1 for v in without.values()), "which of several rows without ids stays is by hash"
    return kept + [r for v in without.values() for r in v]


def brute_clean(rows, items):
    def tokens(text):
        return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = set()
    for _, t in items:
        w = tokens(t)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}

    def hit(text):
        w = tokens(text)
        return any(tuple(w[i : i + k]) in windows for k in sizes for i in range(len(w) - k + 1))

    return [r for r in rows if not hit(r[1])]


def test_toxicity_stage(spark, planted, sf):
    rows, _, _ = planted
    model = model_of(spark, rows, sf)
    assert len(model.weights) > 3
    want = Counter(r for r in rows if brute_toxic(model, r[1]) < toxicity.THRESHOLD)
    assert 0 < len(rows) - sum(want.values()) < 60
    docs = make_docs(spark, rows).repartition(4)
    got = STAGES["toxicity"](spark, docs, sf)
    assert got.columns == docs.columns
    assert kept_rows(got) == want
    assert not any("vile" in (t or "") for _, t, *_ in want)


def test_exact_dedup_stage(spark, planted, sf):
    rows, _, _ = planted
    got = STAGES["exact dedup"](spark, make_docs(spark, rows).repartition(4), sf)
    assert tuple(got.columns) == COLUMNS
    found, want = kept_rows(got), Counter(brute_exact(rows))
    assert Counter((r[0], r[1] or "") for r in found.elements()) == Counter((r[0], r[1] or "") for r in want.elements())
    assert sum(found.values()) == len({r[1] or "" for r in rows})


def test_near_dedup_stage(spark, planted, sf):
    rows = brute_exact(planted[0])
    rows = [r for r in rows if r[0] is not None or r[1] != "alone without an id"] + [(None, "alone without an id", None, None)]
    rows = list(dict.fromkeys(rows))
    got = STAGES["near dedup"](spark, make_docs(spark, rows).repartition(4), sf)
    assert tuple(got.columns) == COLUMNS
    assert kept_rows(got) == Counter(brute_near(rows))
    assert len(rows) - sum(Counter(brute_near(rows)).values()) >= 15


def test_near_dedup_of_rows_without_ids(spark, sf):
    rows = [(None, "a b c d e", None, None), (None, "a  b c d e", None, None), (None, "x y z", None, None)]
    got = kept_rows(STAGES["near dedup"](spark, make_docs(spark, rows), sf))
    assert sum(got.values()) == 2 and (None, "x y z", None, None) in got


def test_decontamination_stage(spark, planted, sf):
    rows, items, _ = planted
    got = STAGES["decontamination"](spark, make_docs(spark, rows).repartition(4), sf)
    assert tuple(got.columns) == COLUMNS
    want = Counter(brute_clean(rows, items))
    assert kept_rows(got) == want
    assert len(rows) - sum(want.values()) >= 9


def test_shards_of_a_batch_agree(planted):
    """What a shard finds does not depend on where a batch is cut."""
    rows, items, _ = planted

    class Block:
        value = fm_index.Phrases.of([(i, (t or "").encode()) for i, t in items], 10)

    data = [(r[1] or "").encode() for r in rows]
    whole = [bool(s) for _, _, s, _ in fm_index.shard_rows(data, data, [Block])]
    cut = [bool(s) for d in data for _, _, s, _ in fm_index.shard_rows([d], [d], [Block])]
    assert whole == cut == [r not in brute_clean([r], items) for r in rows]


@pytest.mark.parametrize("name", STAGES)
def test_stages_of_nothing(spark, none, sf, name):
    assert STAGES[name](spark, none, sf).count() == 0


def test_run(spark, planted, sf):
    """The stages' effects add up; the mixture is that of the documents which are left."""
    rows, items, _ = planted
    left = spark.read.parquet(f"{sf}/documents.parquet").collect()
    plain = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in left]
    model = toxicity.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    plain = [r for r in plain if brute_toxic(model, r[1]) < toxicity.THRESHOLD]
    plain = brute_clean(brute_near(brute_exact(plain)), items)
    want = mixing.mix(mixing.token_counts(make_docs(spark, plain)))
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert {r["doc_id"] for r in got.collect()} <= {r[0] for r in plain}
