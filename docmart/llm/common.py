"""What several operators share: whole texts as bytes, tables in the shared folder, word positions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.session import scratch_path

# Byte classes that the contracts fix. ``bytes.split()`` without an argument splits at
# exactly 0x20 and 0x09-0x0D, so it needs no table.
_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
ALNUM = bytes(b if b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", id_type: str = "long") -> DataFrame:
    """``(doc_id, data binary)``: the whole text in UTF-8, null as empty. Other columns go, so none of
    them can clash with those an operator makes."""
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast(id_type).alias("doc_id"), data.alias("data"))


def held_out(doc_id: Column) -> Column:
    """``crc32(doc_id as text) mod 4 = 2``; a null id counts as held out: nothing is learnt from it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the folder that the cluster shares and read it back: later reads need no
    recomputation and no executor's disk. The files go when the driver ends."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rows_of(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns), strict=True)


def flush(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    """Rows as one Arrow batch; the list is emptied."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    out = pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
    rows.clear()
    return out


def merge_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-open spans, sorted by start, as maximal disjoint runs; touching spans join."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    first = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[first], reach[np.concatenate((np.flatnonzero(first)[1:] - 1, [len(starts) - 1]))]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
