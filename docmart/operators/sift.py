"""Rows that cannot match are kept out of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 19  # 64-bit words of the bitmap at most: what is broadcast has this bound


def sift(df: DataFrame, key: str, ids: DataFrame, words: int = WORDS) -> DataFrame:
    """``df`` with ``__may``: false where ``key`` is surely not among ``ids`` (one column), true where
    it is and, rarely, where it is not. A null key is in nothing.

    The ids are hashed into a bitmap with some 16 bits for each, and ``words`` words at most, so it can
    be broadcast whatever their number; beyond a few ids a bit it lets more and more rows pass, which
    costs their shuffle and nothing else.
    """
    name = ids.columns[0]
    known = ids.where(F.col(name).isNotNull())
    size = min(words, max(1, known.count() // 4))

    def word(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(size))

    def bit(c: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(1), c), F.lit(64)).cast("int")

    shift = F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col(name)))
    bitmap = known.groupBy(word(F.col(name)).alias("__word")).agg(F.bit_or(shift).alias("__mask"))
    met = df.join(F.broadcast(bitmap), word(F.col(key)) == F.col("__word"), "left")
    set_ = F.call_function("shiftrightunsigned", F.col("__mask"), bit(F.col(key))).bitwiseAND(F.lit(1)) == 1
    return met.withColumn("__may", F.col(key).isNotNull() & F.coalesce(set_, F.lit(False))).drop("__word", "__mask")


def sifted_join(df: DataFrame, right: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """``df`` left-joined to ``right`` on ``key``, which is unique there. Only rows that may match are
    shuffled; ``df`` is read twice. ``right`` should be a stored table."""
    marked = sift(df, key, right.select(key), words)
    met = marked.where("__may").drop("__may").join(right, key, "left")
    rest = marked.where("not __may").drop("__may")
    more = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    return met.unionByName(rest.select("*", *more))
