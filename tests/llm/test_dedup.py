"""Dedup operators against brute force on a corpus of hard cases."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from docmart.llm import exact_dedup, repeats, rlz, simhash, suffix
from docmart.llm.components import components


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def rows(frame):
    return Counter(tuple(r) for r in frame.collect())


# ---- exact -------------------------------------------------------------------


def test_exact_groups(docs, corpus):
    groups = defaultdict(list)
    for i, t, *_ in corpus:
        groups[t or ""].append(i)
    want = Counter()
    for i, t, *_ in corpus:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        want[(i, keep, len(groups[t or ""]), i == keep, sha((t or "").encode()))] += 1
    assert rows(exact_dedup.exact_groups(docs)) == want


def test_exact_groups_of_nothing(none):
    assert exact_dedup.exact_groups(none).count() == 0


@given(st.lists(st.lists(st.integers(0, 400), max_size=40), max_size=6), st.integers(1, 5))
@settings(max_examples=60, deadline=None)
def test_merged_filters_are_the_filter_of_all(parts, run_bits):
    rest_bits = 9 - run_bits

    def build(values):
        own, counts = np.unique(np.array(values, np.uint64), return_counts=True)
        return exact_dedup.QuotientRuns.of(own, counts.astype(np.uint64), run_bits, rest_bits)

    if parts:
        merged = exact_dedup.merge([exact_dedup.QuotientRuns.read(*build(p).row()) for p in parts], run_bits, rest_bits)
        whole = build([v for p in parts for v in p])
        assert merged.row() == whole.row()
        assert dict(zip(merged.rests(rest_bits).tolist(), merged.counts.tolist(), strict=True)) == Counter(v for p in parts for v in p)


# ---- SimHash -----------------------------------------------------------------


def brute_fingerprint(text, k):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(ids_of, distance):
    """Smallest id of each fingerprint's component."""
    prints = list(ids_of)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for p in prints:
        least[find(p)] += [i for i in ids_of[p] if i is not None]
    return {p: min(least[find(p)], default=None) for p in prints}


@pytest.mark.parametrize("k", [4, 5])
def test_near_groups(docs, corpus, k):
    ids_of = defaultdict(list)
    for i, t, *_ in corpus:
        ids_of[brute_fingerprint(t, k)].append(i)
    name = brute_components(ids_of, 4)
    want = Counter()
    for i, t, *_ in corpus:
        p = brute_fingerprint(t, k)
        want[(i, p - (1 << 64) if p >> 63 else p, name[p])] += 1
    assert rows(simhash.near_groups(docs, k, 4)) == want
    assert len(set(name.values())) < len(name)


def test_near_groups_of_nothing(none):
    assert simhash.near_groups(none).count() == 0


@pytest.mark.parametrize("distance", [0, 2, 4, 7])
def test_links_lose_and_invent_nothing(spark, distance):
    """Random fingerprints at every distance of others, a bucket larger than ``SMALL`` among them."""
    rng = np.random.default_rng(distance)
    prints = set(rng.integers(0, 1 << 63, 20).tolist())
    for p in list(prints):
        for n in range(1, 9):
            for _ in range(3):
                q = p
                for b in rng.choice(64, n, replace=False).tolist():
                    q ^= 1 << b
                prints.add(q)
    base = next(iter(prints))
    prints |= {base ^ (int(x) << 44) for x in rng.choice(1 << 18, 600, replace=False)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "fp long")
    found = {p: p for p in prints}
    roots = components(simhash.links(frame, distance), "t").collect()
    for r in roots:
        found[r.u % (1 << 64)] = r.v % (1 << 64)
    want = brute_components({p: [p if p < (1 << 63) else p - (1 << 64)] for p in prints}, distance)
    groups, wanted = defaultdict(set), defaultdict(set)
    for p in prints:
        groups[found[p]].add(p)
        wanted[want[p]].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, x) for x in range(201, 300)] + [(301, 302), (302, 303), (303, 301), (5, 5)]
    found = {r.u: r.v for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert found == {i: 0 for i in range(1, 101)} | {i: 200 for i in range(201, 300)} | {302: 301, 303: 301}


# ---- repeated stretches ------------------------------------------------------


def brute_spans(items, length, within):
    """Spans of each id; ``items`` are the distinct ``(id, sequence)``, sorted."""
    first = {}
    hit = defaultdict(set)
    for i, seq in items:
        own = {}
        for p in range(len(seq) - length + 1):
            s = seq[p : p + length]
            if s in first or (within and s in own):
                hit[i] |= set(range(p, p + length))
            own.setdefault(s, p)
        for s in own:
            first.setdefault(s, i)
    return hit


def as_runs(hit):
    out = []
    for p in sorted(hit):
        if out and out[-1][1] == p:
            out[-1][1] = p + 1
        else:
            out.append([p, p + 1])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("window", [8, 50])
def test_word_windows(docs, corpus, window):
    items = sorted({(i, tuple((t or "").encode().split())) for i, t, *_ in corpus if i is not None})
    hit = brute_spans(items, window, within=False)
    want = Counter()
    for i, t, *_ in corpus:
        w = (t or "").encode().split()
        gone = hit.get(i, set()) if i is not None else set()
        want[(i, len(w), tuple(as_runs(gone)), b" ".join(x for j, x in enumerate(w) if j not in gone).decode())] += 1
    found = rlz.duplicate_spans(docs, window)
    assert Counter((r[0], r[1], tuple(map(tuple, r[2])), r[3]) for r in found.collect()) == want
    assert any(hit.values())


@pytest.mark.parametrize("length", [24, 100])
def test_byte_strings(docs, corpus, length):
    items = sorted({(i, (t or "").encode()) for i, t, *_ in corpus if i is not None})
    hit = brute_spans(items, length, within=True)
    want = Counter()
    for i, t, *_ in corpus:
        data = (t or "").encode()
        gone = hit.get(i, set()) if i is not None else set()
        want[(i, len(data), tuple(as_runs(gone)), bytes(b for j, b in enumerate(data) if j not in gone))] += 1
    found = suffix.duplicate_spans(docs, length)
    assert Counter((r[0], r[1], tuple(map(tuple, r[2])), bytes(r[3])) for r in found.collect()) == want
    assert hit[85]


def test_repeats_of_nothing(none):
    assert rlz.duplicate_spans(none).count() == 0
    assert suffix.duplicate_spans(none).count() == 0


def test_tasks_that_settle_in_pieces_agree(docs, monkeypatch):
    want = {r[0]: r[2] for r in suffix.duplicate_spans(docs, 30).collect()}
    one = docs.coalesce(1)
    assert {r[0]: r[2] for r in suffix.duplicate_spans(one, 30).collect()} == want


@given(st.lists(st.binary(max_size=40), min_size=1, max_size=5), st.integers(4, 12))
@settings(max_examples=60, deadline=None)
def test_every_stretch_has_one_anchor(texts, length):
    values, bounds = suffix.byte_values(texts)
    found = repeats.anchors(values, bounds, length, max(1, length // 2))
    covered = Counter()
    for d, p, n in zip(found.doc.tolist(), found.first.tolist(), found.count.tolist(), strict=True):
        covered.update((d, p + i) for i in range(n))
    assert covered == Counter({(d, p): 1 for d, t in enumerate(texts) for p in range(len(t) - length + 1)})


@given(st.binary(min_size=1, max_size=60))
def test_hashes_of_equal_stretches_are_equal(data):
    values, _ = suffix.byte_values([data + data])
    h = repeats.Hashes(values)
    n = len(data)
    assert h.of(np.array([0]), np.array([n])) == h.of(np.array([n]), np.array([2 * n]))
    assert (h.all(1)[:n] == h.all(1)[n:]).all()
