"""Target-distribution importance resampling over hashed word runs.

Features are runs of one to three words; each falls into one of ``buckets`` by the crc32 of its
bytes. The counts of all documents and of all target texts give each bucket a gain, the scaled
logarithm of its share in the target over its share in the documents. A document's weight is the
sum of its features' gains. Adding Gumbel noise, fixed by the document's id, to the weights and
taking the highest scores draws without replacement in proportion to the exponentiated weights.

The array of gains is all that tasks share (``buckets`` numbers). Runs of words are never joined:
the crc32 of a run follows from those of its words, so a block of texts is scored by array
operations on its distinct words. Scores are ranked by a radix sort (``radix.py``).

Cases: a null text has no words, weight 0, and cannot be drawn. A null ``doc_id`` takes its noise
from the text ``null`` and comes last among ties. Repeated rows are rows of their own with equal
scores and neighbouring ranks. Without target texts every gain tells only how rare a bucket is. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import ALNUM, rows_of, stage, texts
from docmart.llm.radix import radix_rank

BUCKETS = 10_000
RUN = 3
SCALE = 1000
CHUNK_BYTES = 1 << 22
_BYTES = np.arange(256, dtype=np.uint32)


def _byte_table() -> np.ndarray:
    table = _BYTES.copy()
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


def _compose(shift: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Table of one shift followed by another: four rows of 256, one per byte of the register."""
    return np.stack([_apply(then, row) for row in shift])


def _apply(shift: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return shift[0][crc & 0xFF] ^ shift[1][crc >> 8 & 0xFF] ^ shift[2][crc >> 16 & 0xFF] ^ shift[3][crc >> 24]


def _shift_tables() -> np.ndarray:
    """``[k]``: what ``2**k`` further zero bytes do to a crc32."""
    one = _byte_table()
    words = [_BYTES << np.uint32(8 * j) for j in range(4)]
    tables = [np.stack([(w >> np.uint32(8)) ^ one[w & 0xFF] for w in words])]
    for _ in range(31):
        tables.append(_compose(tables[-1], tables[-1]))
    return np.stack(tables)


SHIFTS = _shift_tables()


def crc_joined(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of ``left + right`` from both crc32 and the bytes in ``right``."""
    out = left.copy()
    for k in range(int(length.max(initial=0)).bit_length()):
        some = np.flatnonzero(length >> k & 1)
        out[some] = _apply(SHIFTS[k], out[some])
    return out ^ right


def features(docs: list[bytes], run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """crc32 of every run of up to ``run`` words, the document of each, and the words per document."""
    index: dict[bytes, int] = {}
    parts = [d.translate(ALNUM).split() for d in docs]
    n_words = np.fromiter(map(len, parts), np.int64, len(parts))
    codes = np.fromiter((index.setdefault(w, len(index)) for p in parts for w in p), np.int64, int(n_words.sum()))
    alone = np.fromiter(map(zlib.crc32, index), np.uint32, len(index))
    behind = np.fromiter((zlib.crc32(w, zlib.crc32(b" ")) for w in index), np.uint32, len(index))
    length = np.fromiter(map(len, index), np.int64, len(index)) + 1
    owner = np.repeat(np.arange(len(docs)), n_words)
    found, owners = [alone[codes]], [owner]
    now, at = found[0], np.arange(len(codes))
    for k in range(1, run):
        goes_on = at + k < len(codes)
        now, at = now[goes_on], at[goes_on]
        same = owner[at] == owner[at + k]
        now, at = now[same], at[same]
        last = codes[at + k]
        now = crc_joined(now, behind[last], length[last])
        found.append(now)
        owners.append(owner[at])
    return np.concatenate(found), np.concatenate(owners), n_words


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    ids, data, size = [], [], 0
    for i, d in rows_of(batches, "doc_id", "data"):
        ids.append(i)
        data.append(d)
        size += len(d)
        if size >= CHUNK_BYTES:
            yield ids, data
            ids, data, size = [], [], 0
    if ids:
        yield ids, data


def bucket_counts(docs: DataFrame, run: int, buckets: int) -> np.ndarray:
    """Features per bucket over all ``(doc_id, data)`` rows: one row per task and bucket is summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, data in _chunks(batches):
            crc, _, _ = features(data, run)
            total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in docs.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Whole-numbered gain of each bucket from its counts, one added to each."""
    n = len(source)
    all_source, all_target = float(source.sum()) + n, float(target.sum()) + n
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(scale * math.log((t + 1) * all_source / ((s + 1) * all_target))) for s, t in pairs], np.int64)


def noise(doc_id: int | None, seed: int, scale: int = SCALE) -> int:
    name = "null" if doc_id is None else str(doc_id)
    h = int.from_bytes(hashlib.sha256(f"{seed}:{name}".encode()).digest()[:4], "big")
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


_SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def scores(docs: DataFrame, gain: np.ndarray, run: int = RUN, seed: int = 42, scale: int = SCALE) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of ``(doc_id, data)`` rows."""

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data in _chunks(batches):
            crc, owner, n_words = features(data, run)
            n = np.bincount(owner, minlength=len(ids))
            weight = np.zeros(len(ids), np.int64)
            np.add.at(weight, owner, gain[crc % np.uint32(len(gain))])
            score = weight + np.array([noise(i, seed, scale) for i in ids], np.int64)
            columns = [pa.array(ids, pa.int64()), pa.array(n_words), pa.array(n.astype(np.int64)), pa.array(weight), pa.array(score)]
            yield pa.record_batch(columns, names=["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.mapInArrow(run_, _SCORED)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    min_words: int = 20,
    buckets: int = BUCKETS,
    run: int = RUN,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)``, one row per row of ``docs``. Of the
    documents with ``min_words`` words and more, ``percent`` per cent are drawn, rounded down; the
    others have no rank."""
    rows = texts(docs, id_col, text_col)
    aims = texts(target.select(F.lit(0).alias("doc_id"), F.col(target_text_col).alias("text")))
    gain = gains(bucket_counts(rows, run, buckets), bucket_counts(aims, run, buckets))
    scored = stage(scores(rows, gain, run, seed), "scores")
    enough = scored.where(F.col("n_words") >= min_words)
    draw = percent * enough.count() // 100
    ranked = radix_rank(enough, [("score", True), ("doc_id", False)])
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    return drawn.union(scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))
