"""The prefix trie against brute force; centroid decomposition against plain sums."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmart.llm import trie

COLUMNS = "conv_id long, turn long, role string, text string, depth string, owner int, size string, h1 int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], COLUMNS)


def rebuilt(rows):
    """Conversations of ``(conv_id, turn, role, text)``, ties of a turn left as they come."""
    plain = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            plain[c].append(((turn is not None, turn or 0), role or "", text or ""))
    plain = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in plain.items()}
    out = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        out[c] = plain.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members, ends, children = defaultdict(set), defaultdict(list), defaultdict(set)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].add(c)
            if d:
                children[tuple(seq[: d - 1])].add(tuple(seq[:d]))
        ends[tuple(seq)].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = own + sum(saved[k] for k in children[node])
    return Counter(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def shown(frame):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert set(dict(frame.drop("ends_sha256").dtypes).values()) == {"bigint"}
    return Counter(tuple(r[n] for n in names) for r in frame.collect())


def conversations():
    rng = random.Random(4)
    rows = []
    for c in [*range(40), 43, 44, 47, -3, -5, 1001]:
        if c in (10, 25):  # absent, so that others have no opening to share
            continue
        for t in range(rng.choice([1, 2, 5, 12])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "é" * rng.randrange(3), None, "long " * 300])))
    rows += [(60, None, "user", "first"), (60, 0, "user", "second"), (60, 7, None, None), (60, 7, "", "")]
    rows += [(None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [(65, t, "user", str(t // 2)) for t in range(70)]  # a long one
    rows += [(c, t, "user", str(t // 2)) for c in (66, 67) for t in range(70)]
    rows += [(70, 1, "user", "same")] * 5
    return rows


@pytest.mark.parametrize("limit", [4, 40, 4096])
def test_trie(spark, limit):
    rows = conversations()
    turns, convs = trie.forked(trie.turns(table(spark, rows).repartition(4)))
    got = shown(trie.prefix_trie(turns, convs, limit))
    assert got == brute(rebuilt(rows))


def test_one_conversation_and_none(spark):
    rows = [(3, 0, "user", "a")]
    turns, convs = trie.forked(trie.turns(table(spark, rows)))
    assert shown(trie.prefix_trie(turns, convs)) == brute(rebuilt(rows))
    turns, convs = trie.forked(trie.turns(table(spark, [])))
    assert trie.prefix_trie(turns, convs).count() == 0


@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=60), st.booleans())
@settings(max_examples=200, deadline=None)
def test_finish_totals_every_subtree(seeds, path):
    n = len(seeds)
    parent = np.array([-1 if i == 0 or s % 11 == 0 else (i - 1 if path else s % i) for i, s in enumerate(seeds)])
    values = np.array([seeds, [1] * n])
    want = values.copy()
    for i in reversed(range(n)):
        if parent[i] >= 0:
            want[:, parent[i]] += want[:, i]
    assert (trie.finish(parent, want[1].copy(), values) == want).all()


def test_query(spark, sf):
    from docmart.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert shown(QUERIES["op13_prefix_trie"](spark, sf)) == brute(rebuilt(rows))
