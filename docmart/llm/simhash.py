"""SimHash near-dedup by deletion-variant signatures.

A fingerprint has 64 bits; two are linked at ``distance`` or fewer differing bits. Cut into
``distance // 2 + 1`` segments, one segment of a linked pair differs by one bit at most. Each
segment is therefore indexed once per bit with that bit as a wildcard: 64 variants for a
fingerprint, and a linked pair agrees in one of them at least. Equal variants meet and are
verified on all 64 bits, so no link is lost and none is invented.

Only distinct fingerprints are indexed; copies join their fingerprint afterwards. Within a
bucket of equal variants the links are reduced to a spanning forest before they leave the
task, so a bucket of n gives fewer than n links, not n squared.

Cases: a null text has no words, and its fingerprint is zero like that of any text without
words. A null ``doc_id`` takes part but never names a component, unless no id of it is given.
Repeated rows share one component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from docmart.llm.common import rows_of, stage, texts
from docmart.llm.components import components

SEED = 42
BLOCK = 1 << 14  # shingles whose bits are counted at once
SMALL = 256  # buckets up to this size are compared by shifted arrays, larger ones by search


def shingle_hashes(data: bytes, words_each: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included; a shorter text is one shingle."""
    words = data.lower().split()
    if len(words) <= words_each:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - words_each + 1].tolist(), ends[words_each - 1 :].tolist(), strict=True)
    return np.array([xxh64_intdigest(line[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(data: bytes, words_each: int) -> int:
    hashes = shingle_hashes(data, words_each)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i : i + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return sum(1 << j for j in np.flatnonzero(2 * ones > len(hashes)).tolist())


def fingerprints(
    docs: DataFrame, words_each: int, id_col: str = "doc_id", text_col: str = "text", id_type: str = "long"
) -> DataFrame:
    """``(doc_id, fp)``, ``fp`` as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(d, words_each) for (d,) in rows_of([batch], "data")]
            yield pa.record_batch([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return texts(docs, id_col, text_col, id_type).mapInArrow(run, f"doc_id {id_type}, fp long")


def variant_masks(distance: int) -> list[int]:
    """For each of the 64 bits its segment without that bit, as signed longs."""
    parts = distance // 2 + 1
    bounds = [64 * i // parts for i in range(parts + 1)]
    masks = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        masks += [((1 << b) - (1 << a)) & ~(1 << j) for j in range(a, b)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(group: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join, within each group, what verified links join: each row's fingerprint and
    the first one of its part of the group. ``group`` is sorted."""
    n = len(fp)
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(first, n))
    of_row = np.repeat(size, size)
    root = np.arange(n)
    rows = np.flatnonzero((of_row > 1) & (of_row <= SMALL))
    left, right = [], []
    for lag in range(1, int(of_row[rows].max(initial=1))):
        rows = rows[(rows + lag < n)]
        rows = rows[group[rows + lag] == group[rows]]
        near = rows[np.bitwise_count(fp[rows] ^ fp[rows + lag]) <= distance]
        left.append(near)
        right.append(near + lag)
    if left:
        a, b = np.concatenate(left), np.concatenate(right)
        while True:  # the smallest row reachable, by links between rows of the same group
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
    for start, count in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
        left_over = np.arange(start, start + count)
        while len(left_over):  # each row is compared only with the rows not yet reached
            top, ahead = left_over[0], [left_over[0]]
            left_over = left_over[1:]
            while ahead and len(left_over):
                near = np.bitwise_count(fp[left_over] ^ fp[ahead.pop()]) <= distance
                root[left_over[near]] = top
                ahead.extend(left_over[near].tolist())
                left_over = left_over[~near]
    linked = root != np.arange(n)
    return fp[linked], fp[root[linked]]


def links(prints: DataFrame, distance: int) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints ``fp`` that give the same components as all
    links within ``distance``."""
    masks = F.array(*[F.struct(F.lit(i).alias("bit"), F.lit(m).cast("long").alias("mask")) for i, m in enumerate(variant_masks(distance))])
    variants = prints.select("fp", F.explode(masks).alias("x")).select(
        F.col("x.bit").alias("bit"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("rest"), "fp"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # parts of the last bucket, which may go on

        def found(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
            bit, rest, fp = (np.concatenate(c) for c in zip(*parts, strict=True))
            new = np.concatenate(([True], (bit[1:] != bit[:-1]) | (rest[1:] != rest[:-1])))
            a, b = forest(np.cumsum(new), fp.view(np.uint64), distance)
            pairs = np.unique(np.stack((a, b), axis=1), axis=0).view(np.int64) if len(a) else np.zeros((0, 2), np.int64)
            return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            bit, rest, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            last = (bit == bit[-1]) & (rest == rest[-1])
            cut = len(fp) - int(last.sum())
            if held and (cut or (held[-1][0][-1], held[-1][1][-1]) != (bit[-1], rest[-1])):
                held.append([bit[:cut], rest[:cut], fp[:cut]])
                yield found(held)
                held = []
            elif cut:
                yield found([[bit[:cut], rest[:cut], fp[:cut]]])
            held.append([bit[cut:], rest[cut:], fp[cut:]])
        if held:
            yield found(held)

    met = variants.repartition("bit", "rest").sortWithinPartitions("bit", "rest")
    return met.mapInArrow(verify, "a long, b long").distinct()


def near_groups(docs: DataFrame, words_each: int = 5, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)``: the smallest id that links lead to, its own included."""
    prints = stage(fingerprints(docs, words_each, id_col, text_col), "prints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), distance), "near")
    of_fp = distinct.join(roots.select(F.col("u").alias("fp"), "v"), "fp", "left").select("fp", "least", F.coalesce("v", "fp").alias("root"))
    names = of_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(of_fp.join(names, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words_each: int = 5, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each group of :func:`near_groups` the one with the
    smallest id stays, or without any id the one whose text has the smallest hash. A row is found
    again by its id and a hash of its text; rows that repeat both share one fate."""
    mark = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    named = docs.select(F.struct(F.col(id_col).cast("long").alias("id"), mark.alias("mark")).alias("key"), F.col(text_col).alias("text"))
    prints = stage(fingerprints(named, words_each, "key", "text", "struct<id:long,mark:long>"), "prints")
    roots = components(links(prints.select("fp").distinct(), distance), "near")
    rooted = prints.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select(F.col("doc_id").alias("key"), F.coalesce("v", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("key.id").isNull().alias("none"), "key")).alias("first"))
    others = rooted.join(first, "root").where("key <> first.key")
    # Written, so that Catalyst knows its size before it chooses how to join.
    others = stage(others.select(F.col("key.id").alias("_id"), F.col("key.mark").alias("_mark")).distinct(), "near-copies")
    return docs.join(others, F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (mark == F.col("_mark")), "left_anti")
