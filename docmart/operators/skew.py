"""Equi-joins in which a few keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 1000


def heavy_keys(df: DataFrame, keys: Sequence[str], share: int = SHARE) -> DataFrame:
    """The keys that hold more than one in ``share`` rows of ``df``: fewer than ``share`` of them, so
    they can be broadcast whatever the size of ``df``. Counted exactly, with a map-side combine."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return of_counts(counted, keys, "__n", share)


def of_counts(counted: DataFrame, keys: Sequence[str], n: str, share: int = SHARE) -> DataFrame:
    """The same from a table of keys and their row counts."""
    total = counted.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    return counted.where(F.col(n) * share > total).select(*keys)


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], heavy: DataFrame, how: str = "left") -> DataFrame:
    """``left`` joined to ``right``, whose ``keys`` are unique; ``how`` is ``left`` or ``inner``.

    Rows with a key of ``heavy`` (:func:`heavy_keys`) meet its few rows of ``right`` by broadcast
    and stay where they are; only the others are shuffled, and no key of theirs is heavy. Both
    branches read ``left``, so it should be a stored table.
    """
    hot = F.broadcast(heavy.select(*keys).distinct())
    few = right.join(hot, list(keys), "left_semi")
    held = left.join(hot, list(keys), "left_semi").join(F.broadcast(few), list(keys), how)
    # Never broadcast: the size of what is left of ``right`` has no bound.
    rest = left.join(hot, list(keys), "left_anti").join(right.hint("shuffle_merge"), list(keys), how)
    return held.unionByName(rest)
