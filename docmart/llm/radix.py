"""Ranks of rows by a distributed LSD radix sort.

Rows keep a ``place``, from 0 on, and lie in blocks of neighbouring places. A pass takes one digit
of the key, the least significant first, and is a stable counting sort: every block counts its
digits; a digit's global start is the number of all smaller digits, and a block's start within it
is the number of that digit in earlier blocks; a row goes to that start plus its number among the
rows of its block with the same digit. After the last digit the place is the rank.

A task holds one block of ``block`` rows at most, whatever the keys: equal keys get different
places. What meets per digit is one row per block; what reaches the driver is one number per digit.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmart.llm.common import stage
from docmart.session import delete_path

SIGN = -(1 << 63)


class Digit(NamedTuple):
    key: Column  # a long, taken as unsigned
    shift: int


def digits(rows: DataFrame, keys: Sequence[tuple[str, bool]], bits: int) -> list[Digit]:
    """Digits of a composite key of longs, the least significant first. ``keys`` are names and
    whether they fall, the most significant first; nulls come last. Digits that no row differs in
    are left out."""
    ends = rows.agg(*[f(F.col(k)) for k, _ in keys for f in (F.min, F.max, lambda c: F.count_if(c.isNull()))]).first()
    out = []
    for i, (name, falling) in reversed(list(enumerate(keys))):
        low, high, nulls = ends[3 * i : 3 * i + 3]
        if low is not None:
            if high - low < 1 << 63:
                span = high - low
                key = (F.lit(high) - F.col(name)) if falling else (F.col(name) - F.lit(low))
            else:
                span = (1 << 64) - 1
                key = F.col(name).bitwiseXOR(F.lit(SIGN + (1 << 64) - 1 if falling else SIGN))
            key = F.coalesce(key, F.lit(0).cast("long"))
            out += [Digit(key, s) for s in range(0, span.bit_length(), bits)]
        if nulls:
            out.append(Digit(F.col(name).isNull().cast("long"), 0))
    return out


def _pass(rows: DataFrame, digit: Digit, bits: int, block: int) -> DataFrame:
    spark = rows.sparkSession
    value = F.shiftrightunsigned(digit.key, digit.shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    marked = rows.withColumn("__digit", value)
    counts = marked.groupBy("__digit", "__block").agg(F.count("*").alias("n"))
    totals = sorted(counts.groupBy("__digit").agg(F.sum("n").alias("n")).collect())  # one per digit
    ends = np.cumsum([t["n"] for t in totals], dtype=np.int64).tolist()
    first = [(t["__digit"], end - t["n"]) for t, end in zip(totals, ends, strict=True)]
    starts = spark.createDataFrame(first, "__digit int, start long")
    before = Window.partitionBy("__digit").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(F.broadcast(starts), "__digit")
        .select(F.col("__block").alias("__of"), F.col("__digit").alias("digit"), (F.col("start") + F.col("before")).alias("start"))
    )

    def move(part: pa.Table, own: pa.Table) -> pa.Table:
        part = part.take(pc.sort_indices(part, sort_keys=[("__place", "ascending")]))
        digit_of = part.column("__digit").to_numpy()
        start = np.zeros(1 << bits, np.int64)
        start[own.column("digit").to_numpy()] = own.column("start").to_numpy()
        order = np.argsort(digit_of, kind="stable")
        sorted_ = digit_of[order]
        new = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
        number = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
        place = np.empty(len(order), np.int64)
        place[order] = start[sorted_] + number
        out = part.drop_columns(["__digit", "__place", "__block"])
        return out.append_column("__place", pa.array(place)).append_column("__block", pa.array(place // block))

    kept = rows.drop("__place", "__block").schema
    ddl = kept.add("__place", "long").add("__block", "long")
    return marked.groupBy("__block").cogroup(offsets.groupBy("__of")).applyInArrow(move, ddl)


def radix_rank(rows: DataFrame, keys: Sequence[tuple[str, bool]], bits: int = 11, block: int = 1 << 17) -> DataFrame:
    """``rows`` with ``rank``, 1 for the first of the order of ``keys`` (name, falling?); nulls are last.

    Keys are longs. Rows that tie in all keys get neighbouring ranks. The rows travel once a digit, so
    they should be narrow. Every pass is written to the shared folder.
    """
    spark = rows.sparkSession
    place = F.monotonically_increasing_id()
    # The first blocks are the tasks that made the rows; once written they are fixed.
    now = stage(rows.withColumn("__place", place).withColumn("__block", F.shiftright(place, 33)), "radix")
    some = digits(now, keys, bits) or [Digit(F.lit(0).cast("long"), 0)]
    for digit in some:
        new = stage(_pass(now, digit, bits, block), "radix")
        files = now.inputFiles()
        if files:
            delete_path(spark, files[0].rsplit("/", 1)[0])
        now = new
    return now.withColumn("rank", F.col("__place") + 1).drop("__place", "__block")
