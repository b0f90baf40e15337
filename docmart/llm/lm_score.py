"""Documents scored by the difference of two language models' cross-entropies.

The target model is counted over documents chosen by the caller, the background model over all
documents. They are matched: one vocabulary, one order, one smoothing,
``p(b | a) = MIX * c(a b) / c(a) + (1 - MIX) * (c(b) + 1) / (N + V)``. A document's score is the
mean over its words of ``log p_background - log p_target``: the lower, the more it is like the
target.

The vocabulary is every word of the corpus (V counts two more, the start and an unknown word),
unless the caller bounds it to the most frequent ones. No task holds a model: documents are packed
into blocks of about ``BLOCK`` bytes; a block sends each of its distinct words and pairs once (with how often a word is the last,
as ``c(a)`` counts where another follows), dealt by hash to buckets whose number grows with the corpus, a bucket sums them over all blocks, and
each block gets the sums of exactly its own words and pairs back. Words and pairs are told apart by
62 bits of a hash.

Cases: a null or empty text has no words and scores 0. Without any target document the target
model is the uniform one. A null ``doc_id`` counts for the background and is scored. Ties in a
bounded vocabulary go by word. Repeated rows count each. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from docmart.llm.common import ALNUM, mix64, rows_of, stage, texts
from docmart.llm.repeats import _pack, _unpack

MIX = 0.7
UNKNOWN, START = b" unknown", b" start"  # no word has a space
BLOCK = 1 << 21
BUCKET = 1 << 21  # bytes of text for each bucket
PACKED = "block long, n_bytes long, ids array<long>, sizes array<long>, targets array<boolean>, data binary"
SUMS = ("everywhere", "target", "last_everywhere", "last_target")
SENT = "bucket long, block long, keys binary, everywhere binary, target binary, last_everywhere binary, last_target binary"
SUMMED = "bucket long, block long, everywhere binary, target binary, last_everywhere binary, last_target binary, n_words long, n_everywhere long, n_target long"


def word_counts(rows: DataFrame) -> DataFrame:
    """``(word, target, everywhere)`` over ``(data, target)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, total = Counter(), Counter()
        for data, target in rows_of(batches, "data", "target"):
            words = data.translate(ALNUM).split()
            total.update(words)
            if target:
                inside.update(words)
        words = list(total)
        for i in range(0, len(words), 100_000):
            part = words[i : i + 100_000]
            yield pa.record_batch([pa.array(part, pa.binary()), pa.array([inside[w] for w in part], pa.int64()), pa.array([total[w] for w in part], pa.int64())], names=["word", "target", "everywhere"])

    counted = rows.mapInArrow(count, "word binary, target long, everywhere long")
    return counted.groupBy("word").agg(F.sum("target").alias("target"), F.sum("everywhere").alias("everywhere"))


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _whole(cell: bytes) -> bytes:
    return pa.decompress(cell[8:], int.from_bytes(cell[:8], "little"), codec="zstd", asbytes=True)


def packed(rows: DataFrame) -> DataFrame:
    """The documents ``(doc_id, data, target)`` in blocks, one row each."""
    names = [c.split()[0] for c in PACKED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, held = TaskContext.get().partitionId() << 32, 0, []

        def block() -> pa.RecordBatch:
            ids, data, targets = zip(*held, strict=True)
            cells = (number, size, list(ids), [len(d) for d in data], list(targets), _squeezed(b"".join(data)))
            return pa.record_batch([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], names=names)

        for row in rows_of(batches, "doc_id", "data", "target"):
            if held and size + len(row[1]) > BLOCK:
                yield block()
                number, size, held = number + 1, 0, []
            held.append(row)
            size += len(row[1])
        if held:
            yield block()

    return rows.mapInArrow(run, PACKED)


class Block:
    """The words and pairs of a block: ``order`` sorts its ``keys``, which are those of the words,
    the start being the first of them, then of the pairs."""

    def __init__(self, data: bytes, sizes: list[int], keep: frozenset[bytes] | None):
        index: dict[bytes, int] = defaultdict()
        index.default_factory = index.__len__
        index[START]
        ids, at = [], 0
        for size in sizes:
            words = data[at : at + size].translate(ALNUM).split()
            at += size
            if keep is not None:
                words = [w if w in keep else UNKNOWN for w in words]
            ids.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
        self.n = np.array([len(x) for x in ids], np.int64)
        self.doc = np.repeat(np.arange(len(sizes)), self.n)
        self.second = np.concatenate([np.zeros(0, np.int64), *ids])
        self.first = np.concatenate([np.zeros(0, np.int64), *(np.concatenate(([0], x[:-1])) for x in ids if len(x))])
        self.size = len(index)
        self.end = np.array([x[-1] for x in ids if len(x)], np.int64)
        self.end_doc = np.flatnonzero(self.n)
        pairs, self.pair = np.unique(self.first * self.size + self.second, return_inverse=True)
        self.a, self.b = pairs // self.size, pairs % self.size
        word = np.array([xxh64_intdigest(w) for w in index], np.uint64)
        ends = word[self.a] * np.uint64(0x9E3779B97F4A7C15) + mix64(word[self.b])
        self.keys = np.concatenate([k & ~np.uint64(3) | np.uint64(kind) for k, kind in ((mix64(word), 1), (mix64(ends), 0))])
        self.keys[0] ^= np.uint64(3)  # the start is no word
        self.order = np.argsort(self.keys, kind="stable")

    def counts(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each key is in the documents chosen by ``docs``, and at their end, in sorted
        order; the start counts once for each document with words."""
        rows, ends = docs[self.doc], docs[self.end_doc]
        word = np.bincount(self.second[rows], minlength=self.size)
        word[0] = ends.sum()
        both = np.concatenate((word, np.bincount(self.pair[rows], minlength=len(self.a))))
        return both[self.order], np.bincount(self.end[ends], minlength=len(both))[self.order]

    def split(self, sums: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums in sorted order as those of seconds, firsts and pairs, for each pair."""
        back, first = np.empty((2, len(sums)), np.int64)
        back[self.order], first[self.order] = sums, sums - last
        return back[self.b], first[self.a], back[self.size :]


def _sent(blocks: DataFrame, keep, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, data, sizes, targets in rows_of(batches, "block", "data", "sizes", "targets"):
            block = Block(_whole(data), sizes, keep and keep.value)
            (total, last), (inside, inside_last) = (block.counts(d) for d in (np.ones(len(sizes), bool), np.array(targets, bool)))
            keys = block.keys[block.order]
            bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
            spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
            columns = [pa.array(bucket[cuts[:-1]], pa.int64()), pa.array([number] * len(spans), pa.int64())]
            columns += [pa.array([_pack(c[a:b]) for a, b in spans], pa.binary()) for c in (keys, total, inside, last, inside_last)]
            yield pa.record_batch(columns, names=["bucket", "block", "keys", *SUMS])

    return blocks.mapInArrow(run, SENT)


def _summed(sent: DataFrame) -> DataFrame:
    """The sums over all blocks, for each block in the order in which it sent its keys."""

    def run(part: pa.Table) -> pa.Table:
        keys = [_unpack(c, np.uint64) for c in part.column("keys").to_pylist()]
        known, at = np.unique(np.concatenate(keys), return_inverse=True)
        sums = []
        for column in SUMS:
            sum_ = np.zeros(len(known), np.int64)
            np.add.at(sum_, at, np.concatenate([_unpack(c, np.int64) for c in part.column(column).to_pylist()]))
            sums.append(sum_)
        ends = np.cumsum([len(k) for k in keys])
        words = known & np.uint64(3) == 1
        totals = [int(words.sum()), int(sums[0][words].sum()), int(sums[1][words].sum())]
        columns = [part.column("bucket"), part.column("block")]
        columns += [pa.array([_squeezed(_pack(s[p])) for p in np.split(at, ends[:-1])], pa.binary()) for s in sums]
        columns += [pa.array([t] + [0] * (len(keys) - 1), pa.int64()) for t in totals]  # once for the bucket
        return pa.table(columns, names=[c.split()[0] for c in SUMMED.split(", ")])

    return sent.groupBy("bucket").applyInArrow(run, SUMMED)


def loss(block: Block, sums: list[np.ndarray], n: list[int], size: int) -> np.ndarray:
    """``log p_background - log p_target`` for each pair of the block."""
    logs = []
    for total, last, of_model in zip(sums[:2], sums[2:], n, strict=True):
        second, first, pair = block.split(total, last)
        low = (second + 1) / (of_model + size)
        share = np.divide(pair, first, out=np.zeros(len(pair)), where=first > 0)
        logs.append(np.log(np.where(first > 0, MIX * share + (1 - MIX) * low, low)))
    return logs[0] - logs[1]


def _stage_alone(df: DataFrame, label: str) -> DataFrame:
    """:func:`stage`, whose shuffle files go when the table is written: nothing reads them again."""
    spark, name = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        return stage(df, label)
    finally:
        spark.conf.set(name, before)


def score(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: int | None = None) -> DataFrame:
    """``(doc_id, n_words, score)``; ``targets`` has the ids of the target documents. A bounded
    ``vocabulary`` counts the start and the unknown word."""
    chosen = targets.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct().withColumn("target", F.lit(True))
    # The targets grow with the corpus and are never broadcast; each id is there once.
    chosen = chosen.hint("shuffle_merge")
    rows = texts(docs, id_col, text_col).join(chosen, "doc_id", "left").select("doc_id", "data", F.coalesce("target", F.lit(False)).alias("target"))
    keep = None
    if vocabulary is not None:
        top = word_counts(rows).orderBy(F.desc("everywhere"), "word").limit(vocabulary - 2).collect()
        keep = docs.sparkSession.sparkContext.broadcast(frozenset(bytes(r["word"]) for r in top))
    blocks = _stage_alone(packed(rows), "lm")
    n_bytes = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    bits = max(1, (n_bytes // BUCKET).bit_length())
    summed = _stage_alone(_summed(_sent(blocks, keep, bits)), "lm-sums")
    n_words, *n = (x or 0 for x in summed.agg(F.sum("n_words"), F.sum("n_everywhere"), F.sum("n_target")).first())
    size = vocabulary if vocabulary is not None else n_words + 2

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        sent = right.sort_by("bucket")
        sums = [np.concatenate([np.zeros(0, np.int64), *(_unpack(_whole(c), np.int64) for c in sent.column(k).to_pylist())]) for k in SUMS]
        (data,), (sizes,), (ids,) = (left.column(c).to_pylist() for c in ("data", "sizes", "ids"))
        block = Block(_whole(data), sizes, keep and keep.value)
        total = np.bincount(block.doc, loss(block, sums, n, size)[block.pair], minlength=len(sizes))
        mean = total / np.maximum(block.n, 1)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(block.n, pa.int64()), "score": pa.array(mean, pa.float64())})

    sums = summed.select("block", "bucket", *SUMS)
    return blocks.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(run, "doc_id long, n_words long, score double")
