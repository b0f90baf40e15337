"""Connected components of a graph that no single task has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import stage
from docmart.session import delete_path


def _star_round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step. Edges ``(u, v)`` have ``u > v``."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u")
    hooked = small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.union(low.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def components(edges: DataFrame, label: str) -> DataFrame:
    """``(u, v)`` for each node ``u`` but the smallest of its component, which is ``v``.

    Alternating star contraction: each round joins every node's neighbours to the smallest of
    them, so components shrink to stars in a number of rounds that grows with the logarithm of
    their size. Minima are pre-aggregated; a hub's rows meet only in a join, which AQE can
    split. Each round is written to the shared folder, so lineage stays short and a lost
    executor costs one round at most.
    """
    spark = edges.sparkSession
    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), label)

    def seen(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    state = seen(now)
    while state[0]:
        new = stage(_star_round(now), label)
        delete_path(spark, now.inputFiles()[0].rsplit("/", 1)[0])
        now, before = new, state
        state = seen(now)
        if state == before:
            break
    return now
