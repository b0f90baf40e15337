"""Benchmark decontamination by an FM-index of every training shard.

A shard is what a task reads next, up to about ``SHARD_WORDS`` words. Words that no test
phrase has cannot be part of an occurrence, so they only separate the stretches that can. Of
these stretches the shard's suffix array, its Burrows-Wheeler transform and a wavelet matrix
are built. Test phrases are searched backwards, all at once, by ranks in the wavelet matrix;
occurrences are located by walking back to the next sampled suffix position; the hit spans
of a document are merged.

Phrases are all windows of ``window`` words of the test items; a shorter item is one phrase.
The test set is dealt into blocks of about ``BLOCK_BYTES`` bytes. Blocks are taken one after
the other: the driver holds one, sends it, and lets it go when every shard has been searched for it and
the hits are written. Most test sets are one block.

Cases: a null or empty text has no words: a document is never hit, an item gives no phrase. An
item without id marks words but is not listed. Repeated items count once by id. Repeated rows
give a row each. Empty tables give no rows or no hits.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart.llm.common import ALNUM, flush, merge_runs, rows_of, stage, texts
from docmart.operators.sift import sifted_join

SHARD_WORDS = 1 << 20
BLOCK_BYTES = 32 << 20
SAMPLE = 8  # every eighth suffix position is kept
END, GAP = 0, 1  # symbols of the shard that are no words


class Phrases(NamedTuple):
    """A block of the test set. ``words``: symbols, right-aligned, 0 where shorter."""

    symbol: dict[bytes, int]
    words: np.ndarray
    lengths: np.ndarray
    items: list[tuple]

    @classmethod
    def of(cls, rows: list[tuple], window: int) -> Phrases:
        symbol: dict[bytes, int] = {}
        found: dict[tuple, set] = {}
        for item, data in rows:
            words = [symbol.setdefault(w, len(symbol) + 2) for w in data.translate(ALNUM).split()]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[i : i + window]), set()).update([item] if item is not None else [])
        table = np.zeros((len(found), window), np.int64)
        for i, phrase in enumerate(found):
            table[i, window - len(phrase) :] = phrase
        return cls(symbol, table, np.array([len(p) for p in found], np.int64), [tuple(v) for v in found.values()])


class WaveletMatrix:
    """Ranks of symbols in a sequence, for many queries at once."""

    def __init__(self, seq: np.ndarray, top: int):
        self.levels: list[tuple[int, int, np.ndarray]] = []
        for level in range(max(1, top.bit_length()) - 1, -1, -1):
            bit = (seq >> level) & 1
            ones = np.concatenate(([0], np.cumsum(bit))).astype(np.int32)
            self.levels.append((level, len(seq) - int(ones[-1]), ones))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``upto``."""
        start, end = np.zeros_like(upto), upto
        for level, zeros, ones in self.levels:
            one = ((symbol >> level) & 1).astype(bool)
            start = np.where(one, zeros + ones[start], start - ones[start])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return end - start


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling within a shard; the symbols' order is refined until no two suffixes tie."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        rank, step = new, 2 * step
        if int(rank[order[-1]]) == n - 1 or step >= n:
            return order


class FMIndex:
    """Over stretches of symbols above ``GAP``, each followed by a gap."""

    def __init__(self, text: np.ndarray, top: int):
        n = len(text)
        # Gaps are told apart while sorting, so suffixes differ at the end of their stretch.
        gaps = text == GAP
        own = np.where(gaps, np.cumsum(gaps), text + int(gaps.sum()))
        own[text == END] = 0
        order = suffix_array(own)
        self.bwt = text[order - 1]
        self.ranks = WaveletMatrix(self.bwt, top)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        # A walk never steps over a gap: positions behind one are sampled as well.
        self.position = np.where((order % SAMPLE == 0) | (self.bwt <= GAP), order, -1)
        self.n = n

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of right-aligned phrases."""
        low, high = np.zeros(len(words), np.int64), np.full(len(words), self.n, np.int64)
        for column in range(words.shape[1] - 1, -1, -1):
            at = np.flatnonzero((words[:, column] > 0) & (low < high))
            if not len(at):
                break
            c = words[at, column]
            low[at] = self.before[c] + self.ranks.rank(c, low[at])
            high[at] = self.before[c] + self.ranks.rank(c, high[at])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        found, steps = self.position[rows], np.zeros(len(rows), np.int64)
        rows = rows.copy()
        while len(open_ := np.flatnonzero(found < 0)):
            c = self.bwt[rows[open_]]
            rows[open_] = self.before[c] + self.ranks.rank(c, rows[open_])
            steps[open_] += 1
            found[open_] = self.position[rows[open_]]
        return found + steps


def occurrences(docs: list[bytes], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, first word and phrase of every occurrence in a shard."""
    nothing = np.zeros(0, np.int64)
    if not len(phrases.words):
        return nothing, nothing, nothing
    get, shortest = phrases.symbol.get, int(phrases.lengths.min())
    text, owner, place = [], [], []
    for d, data in enumerate(docs):
        words = data.translate(ALNUM).split()
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        edge = np.diff(np.concatenate(([0], (ids > 0).astype(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            if b - a >= shortest:
                text.append(np.append(ids[a:b], GAP))
                owner.append(np.full(b - a + 1, d))
                place.append(np.arange(a, b + 1))
    if not text:
        return nothing, nothing, nothing
    index = FMIndex(np.append(np.concatenate(text), END), len(phrases.symbol) + 1)
    low, high = index.search(phrases.words)
    hit = np.flatnonzero(high > low)
    count = (high - low)[hit]
    rows = np.repeat(low[hit] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    at = index.locate(rows)
    return np.concatenate(owner)[at], np.concatenate(place)[at], np.repeat(hit, count)


def shard_rows(ids: list, docs: list[bytes], blocks: list) -> list[tuple]:
    """What a shard has of the phrases of some blocks, whose ``value`` they are."""
    found = []
    for block in blocks:
        d, start, phrase = occurrences(docs, block.value)
        if len(d):
            found.append((d, start, start + block.value.lengths[phrase], phrase, block.value.items))
    spans: dict[int, list] = {}
    items: dict[int, set] = {}
    if found:
        d, start, end = (np.concatenate([f[i] for f in found]) for i in range(3))
        order = np.lexsort((start, d))
        d, start, end = d[order], start[order], end[order]
        cuts = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1], [True])))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            spans[int(d[a])] = _runs(start[a:b], end[a:b])
        for d, _, _, phrase, names in found:
            for doc, p in np.unique(np.stack((d, phrase), axis=1), axis=0).tolist():
                items.setdefault(doc, set()).update(names[p])
    return [(i, _n_words(t), spans.get(n, []), sorted(items.get(n, ()))) for n, (i, t) in enumerate(zip(ids, docs, strict=True))]


def _n_words(data: bytes) -> int:
    return len(data.translate(ALNUM).split())


def _runs(start: np.ndarray, end: np.ndarray) -> list[dict]:
    """Spans, sorted by start, as maximal disjoint ones."""
    first, last = merge_runs(start, end)
    return [{"start": s, "end": e} for s, e in zip(first.tolist(), last.tolist(), strict=True)]


def phrase_blocks(benchmark: DataFrame, window: int = 10, item_col: str = "item_id", item_text_col: str = "text") -> tuple[int, Iterator[Broadcast]]:
    """The number of blocks of the test set, and the blocks as broadcast variables of bounded size.
    Each is made when it is asked for and released when the next one is."""
    tests = texts(benchmark, item_col, item_text_col)
    size = tests.agg(F.sum(F.length("data"))).first()[0] or 0
    n_blocks = size // BLOCK_BYTES + 1

    def make() -> Iterator[Broadcast]:
        for b in range(n_blocks):
            # By text as well: items without an id are spread like others.
            own = tests.where(F.pmod(F.xxhash64("doc_id", "data"), F.lit(n_blocks)) == b).collect()
            sent = benchmark.sparkSession.sparkContext.broadcast(Phrases.of([(r.doc_id, bytes(r.data)) for r in own], window))
            yield sent
            sent.unpersist()

    return n_blocks, make()


def hit_column(text: Column, block: Broadcast) -> Column:
    """Whether each row's text has a phrase of the block. An Arrow batch is cut into shards by size."""

    @F.pandas_udf("boolean")
    def run(batch: pd.Series) -> pd.Series:
        hit: list[bool] = []
        shard: list[bytes] = []
        size = 0
        for text in batch:
            shard.append(text.encode("utf-8", "replace"))
            size += len(shard[-1])
            if size >= SHARD_WORDS * 6:
                hit += [bool(spans) for _, _, spans, _ in shard_rows(shard, shard, [block])]
                shard, size = [], 0
        hit += [bool(spans) for _, _, spans, _ in shard_rows(shard, shard, [block])]
        return pd.Series(hit, dtype=bool)

    return run(F.coalesce(text.cast("string"), F.lit("")))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a phrase of the test set. Between two blocks what is left is written."""
    n_blocks, blocks = phrase_blocks(benchmark, window, item_col, item_text_col)
    for number in range(1, n_blocks + 1):
        docs = docs.where(~hit_column(F.col(text_col), next(blocks)))
        if number < n_blocks:
            docs = stage(docs, f"clean-{number}")
    return docs


_SPANS = "array<struct<start:long,end:long>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _search(rows: DataFrame, block: Broadcast) -> DataFrame:
    """``(key, n_words, spans, items)`` of rows ``(key, data)``."""
    kind = rows.schema["key"].dataType
    schema = pa.schema([("key", pa.int64() if kind == T.LongType() else pa.string()), ("n_words", pa.int64()), ("spans", _SPAN), ("items", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        held: list[bytes] = []
        size = 0
        for key, data in rows_of(batches, "key", "data"):
            keys.append(key)
            held.append(data)
            size += len(data)
            if size >= SHARD_WORDS * 6:
                yield flush(schema, shard_rows(keys, held, [block]))
                keys, held, size = [], [], 0
        yield flush(schema, shard_rows(keys, held, [block]))

    return rows.mapInArrow(run, f"key {kind.simpleString()}, n_words long, spans {_SPANS}, items array<long>")


def _united(rows: DataFrame) -> DataFrame:
    """``(doc_id, n_words, spans, items)`` of rows ``(doc_id, data, spans, items)`` whose spans and
    items are those of several blocks, or null."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", _SPAN), ("items", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, data, spans, items in rows_of([batch], "doc_id", "data", "spans", "items"):
                both = np.array(sorted((s["start"], s["end"]) for s in spans or ()), np.int64).reshape(-1, 2)
                out.append((doc_id, _n_words(data), _runs(both[:, 0], both[:, 1]), sorted(set(items or ()))))
            yield flush(schema, out)

    return rows.mapInArrow(run, f"doc_id long, n_words long, spans {_SPANS}, items array<long>")


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, spans, items)``: disjoint half-open spans of words to remove, and the
    ids of the items that have a phrase there."""
    rows = texts(docs, id_col, text_col)
    n_blocks, blocks = phrase_blocks(benchmark, window, item_col, item_text_col)
    if n_blocks == 1:
        return _search(rows.withColumnRenamed("doc_id", "key"), next(blocks)).withColumnRenamed("key", "doc_id")
    # Hits of a block are few; rows of one id and text have the same ones.
    named = rows.withColumn("key", F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"), F.lit(b":"), "data"), 256))
    hits = [stage(_search(named.select("key", "data"), b).where("size(spans) > 0").distinct(), "hits") for b in blocks]
    every = functools.reduce(DataFrame.unionByName, hits)
    found = every.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return _united(sifted_join(named, stage(found, "united"), "key").select("doc_id", "data", "spans", "items"))
