"""Exact dedup by counting quotient filters.

Every partition builds a counting quotient filter of its texts' 64-bit fingerprints: the
high bits (quotient) name a run, the low bits (remainder) are kept sorted in it with a
counter. Sorted runs of equal quotients merge by a sorted union that adds counters, so the
merged filter is the one a single build over all rows would give: nothing is lost or
estimated. Only texts whose fingerprint has a count above one are compared byte for byte.

The filters travel in blocks of neighbouring quotients. A block holds one entry per distinct
fingerprint, so copies, however many, weigh as much as one text in a partition's filter.

Cases: a null text is an empty text, and empty texts are copies of each other. A null
``doc_id`` never is the row that stays unless all ids of the group are null. Rows that
repeat both id and text share one fate. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import stage

BLOCK_ROWS = 1 << 18  # rows per block, beyond 256 blocks: what one task merges does not grow
FILTER = pa.schema([("block", pa.int32()), ("lengths", pa.binary()), ("remainders", pa.binary()), ("counts", pa.binary())])
FILTER_DDL = "block int, lengths binary, remainders binary, counts binary"


class QuotientRuns:
    """The part of a counting quotient filter with the same leading ``block_bits``: for every
    quotient of the block its run length, then all runs' remainders (sorted) and counters."""

    def __init__(self, lengths: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.lengths, self.remainders, self.counts = lengths, remainders, counts

    @classmethod
    def of(cls, rests: np.ndarray, counts: np.ndarray, run_bits: int, rest_bits: int) -> QuotientRuns:
        """From sorted values of ``run_bits + rest_bits`` bits, the fingerprints without their block."""
        lengths = np.bincount((rests >> np.uint64(rest_bits)).astype(np.int64), minlength=1 << run_bits)
        return cls(lengths.astype(np.uint32), rests & np.uint64((1 << rest_bits) - 1), counts)

    def rests(self, rest_bits: int) -> np.ndarray:
        runs = np.repeat(np.arange(len(self.lengths), dtype=np.uint64), self.lengths)
        return (runs << np.uint64(rest_bits)) | self.remainders

    def row(self) -> tuple[bytes, bytes, bytes]:
        return self.lengths.tobytes(), self.remainders.tobytes(), self.counts.tobytes()

    @classmethod
    def read(cls, lengths: bytes, remainders: bytes, counts: bytes) -> QuotientRuns:
        return cls(np.frombuffer(lengths, np.uint32), np.frombuffer(remainders, np.uint64), np.frombuffer(counts, np.uint64))


def merge(filters: list[QuotientRuns], run_bits: int, rest_bits: int) -> QuotientRuns:
    """The filter of all rows of several filters of one block."""
    rests = np.concatenate([f.rests(rest_bits) for f in filters])
    order = np.argsort(rests, kind="stable")  # merges the sorted runs
    rests, counts = rests[order], np.concatenate([f.counts for f in filters])[order]
    first = np.flatnonzero(np.concatenate(([True], rests[1:] != rests[:-1]))) if len(rests) else np.zeros(0, np.int64)
    return QuotientRuns.of(rests[first], np.add.reduceat(counts, first) if len(first) else counts, run_bits, rest_bits)


def partition_filters(prints: DataFrame, block_bits: int, run_bits: int) -> DataFrame:
    """One row per partition and block: the partition's filter."""
    rest_bits = 64 - block_bits - run_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for b in batches]
        values, counts = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
        blocks = (values >> np.uint64(64 - block_bits)).astype(np.int64)
        bounds = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1], [True]))) if len(blocks) else []
        rows: list[tuple] = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            rests = values[a:b] & np.uint64((1 << (64 - block_bits)) - 1)
            runs = QuotientRuns.of(rests, counts[a:b].astype(np.uint64), run_bits, rest_bits)
            rows.append((int(blocks[a]), *runs.row()))
        yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(FILTER.types)], schema=FILTER)

    return prints.mapInArrow(build, FILTER_DDL)


def repeated_fingerprints(prints: DataFrame, block_bits: int = 8, run_bits: int = 8) -> DataFrame:
    """``(fp, copies)`` of the fingerprints with a count above one. A block is merged by one task
    and holds ``2**-block_bits`` of the distinct fingerprints: it is to be raised with the corpus."""
    rest_bits = 64 - block_bits - run_bits

    def union(key: tuple, part: pa.Table) -> pa.Table:
        block = key[0].as_py()
        columns = (part.column(c).to_pylist() for c in ("lengths", "remainders", "counts"))
        runs = merge([QuotientRuns.read(*r) for r in zip(*columns, strict=True)], run_bits, rest_bits)
        values = runs.rests(rest_bits) | np.uint64(block << (64 - block_bits))
        over = runs.counts > 1
        return pa.table({"fp": values[over].view(np.int64), "copies": runs.counts[over].astype(np.int64)})

    return partition_filters(prints, block_bits, run_bits).groupBy("block").applyInArrow(union, "fp long, copies long")


def _fingerprinted(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(*more, text.alias("_text"), F.xxhash64(text).alias("_fp"))


def _repeated(rows: DataFrame) -> DataFrame:
    """``_fp`` of the fingerprints that occur more than once. Written, so that Catalyst knows its size:
    below the session's threshold it is broadcast, beyond it the join is a shuffle."""
    blocks = max(8, (rows.count() // BLOCK_ROWS).bit_length())
    return stage(repeated_fingerprints(rows.select("_fp"), blocks, max(0, 16 - blocks)).select(F.col("fp").alias("_fp")), "repeated")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``; of equal
    texts the largest id stays. Only texts of repeated fingerprints are compared; equal ones of a
    task collapse before they meet."""
    rows = _fingerprinted(docs, text_col, F.col(id_col).cast("long").alias("doc_id"))
    suspect = rows.join(_repeated(rows), "_fp", "left_semi")
    # The group key is the text itself: this is the comparison by bytes.
    equal = suspect.groupBy("_fp", "_text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    equal = stage(equal.where("group_size > 1").select(F.sha2("_text", 256).alias("text_sha256"), "keep_id", "group_size"), "equal")
    found = rows.select("doc_id", F.sha2("_text", 256).alias("text_sha256")).join(equal, "text_sha256", "left")
    alone = F.col("group_size").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without copies: one row of each text, the one with the largest id. All
    columns come along, so no row has to be found again by its id; of rows that repeat id and text
    one stays as well. A null text stays null if its row is the one that stays."""
    others = [c for c in docs.columns if c != text_col]
    row = F.struct(F.col(text_col).isNull().alias("_null"), *[F.col(f"`{c}`") for c in others]).alias("_row")
    rows = _fingerprinted(docs, text_col, F.col(id_col).cast("long").alias("_id"), row)
    repeated = _repeated(rows)
    single = rows.join(repeated, "_fp", "left_anti").select("_row", "_text")
    chosen = rows.join(repeated, "_fp", "left_semi").groupBy("_fp", "_text").agg(F.max_by("_row", F.struct("_id")).alias("_row"))
    both = single.union(chosen.select("_row", "_text"))
    text = F.when(~F.col("_row._null"), F.col("_text")).alias(text_col)
    return both.select(*[text if c == text_col else F.col(f"_row.`{c}`") for c in docs.columns])
