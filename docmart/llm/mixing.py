"""Mixing sources by temperature.

A source with token share ``s`` gets the weight ``s ** a / sum(s ** a)``: ``a = 1`` keeps the
shares, ``a = 0`` levels them. The exponent is found by bisection, many points at a time: the
largest that reaches a target entropy, raised if need be until no source is repeated more than
``max_repeats`` times. Weights become token budgets, and budgets become passes over blocks: a
source is read in whole passes, then in a part of one. In every pass the blocks are permuted
anew, and so are the documents of a block.

A block holds about ``block_tokens`` tokens whatever the size of its source, so a source with
a third of the corpus only has more of them. Running totals are taken over blocks; documents
are summed up one by one only in the block where a source's budget ends.

Only DataFrame functions are used. Cases: a null source is a source of its own. Null and empty
texts have no tokens; they come along in whole passes, and a source without tokens has weight
zero and no pass. Rows that repeat an id are placed each. Ties in the order are broken by id,
then by tokens. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmart.llm.common import stage
from docmart.operators.running import Total, running

POINTS = 64
ROUNDS = 6  # the interval of the exponent shrinks to 63 ** -6


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    words = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.cast("long").alias("n_tokens"))


def _scan(shares: DataFrame, points: list[float], budget: float | None) -> list[tuple[float, float, float]]:
    """Exponent, entropy and largest number of repeats at each point; one row per point comes back."""
    at = shares.select("*", F.explode(F.array(*[F.lit(p) for p in points])).alias("a"))
    x = F.col("a") * F.col("log_share")
    sums = at.groupBy("a").agg(
        F.sum(F.exp(x)).alias("z"), F.sum(x * F.exp(x)).alias("xz"), F.max(F.exp(x) / F.col("tokens")).alias("densest")
    )
    rows = sums.select("a", (F.log("z") - F.col("xz") / F.col("z")).alias("h"), (F.col("densest") / F.col("z")).alias("d")).collect()
    return sorted((r.a, r.h, r.d * (budget or 0.0)) for r in rows)


def exponent(shares: DataFrame, budget: float, entropy_share: float | None, max_repeats: float | None) -> float:
    """Both measures fall as the exponent grows: the largest exponent whose entropy reaches
    ``entropy_share`` of the possible, or the smallest above it with at most ``max_repeats``.
    Where even ``a = 1`` repeats more (a budget of many corpora), it stays 1."""
    n = shares.count()
    if not n:
        return 1.0

    def bisect(low: float, high: float, good: int, holds) -> float:
        """``good`` is the end (0 low, 1 high) at which the condition is sought."""
        for _ in range(ROUNDS):
            points = [low + (high - low) * i / (POINTS - 1) for i in range(POINTS)]
            met = [holds(row) for row in _scan(shares, points, budget)]
            if good == 0:  # holds up to some point
                last = max((i for i, m in enumerate(met) if m), default=0)
                low, high = points[last], points[min(last + 1, POINTS - 1)]
            else:  # holds from some point on
                start = min((i for i, m in enumerate(met) if m), default=POINTS - 1)
                low, high = points[max(start - 1, 0)], points[start]
            if low == high:
                break
        return low if good == 0 else high

    a = 1.0
    if entropy_share is not None:
        target = entropy_share * math.log(n) - 1e-12
        a = bisect(0.0, 1.0, 0, lambda row: row[1] >= target)
    elif max_repeats is not None:
        a = 0.0
    if max_repeats is not None:
        a = max(a, bisect(a, 1.0, 1, lambda row: row[2] <= max_repeats + 1e-12))
    return a


def weights(sizes: DataFrame, budget: int | None = None, entropy_share: float | None = None, max_repeats: float | None = None) -> DataFrame:
    """``(source, tokens, weight, exponent, budget)`` per source; ``budget`` of tokens, by default the corpus."""
    totals = stage(sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "sources")
    top = totals.agg(F.max("tokens").alias("most"), F.sum("tokens").alias("all")).first()
    whole = float(budget if budget is not None else top["all"] or 0)
    shares = totals.where("tokens > 0").select("source", "tokens", F.log(F.col("tokens") / F.lit(float(top.most or 1))).alias("log_share"))
    a = exponent(shares, whole, entropy_share, max_repeats)
    z = shares.agg(F.sum(F.exp(F.lit(a) * F.col("log_share")))).first()[0] or 1.0
    weight = F.when(F.col("tokens") > 0, F.exp(F.lit(a) * F.log(F.col("tokens") / F.lit(float(top.most or 1)))) / F.lit(z)).otherwise(F.lit(0.0))
    return totals.withColumn("weight", weight).withColumn("exponent", F.lit(a)).withColumn("budget", F.floor(F.col("weight") * F.lit(whole)))


def _order(seed: int, *parts: Column) -> Column:
    return F.xxhash64(F.lit(seed), *parts)


def mix(
    sizes: DataFrame,
    budget: int | None = None,
    entropy_share: float | None = 0.95,
    max_repeats: float | None = 4.0,
    block_tokens: int = 1 << 18,
    seed: int = 7,
) -> DataFrame:
    """``(doc_id, source, n_tokens, weight, pass, block, block_order, doc_order)``: one row per
    placement of a document. Read by ``(pass, block_order, source, block, doc_order)``."""
    sizes = stage(sizes, "sizes")
    plan = weights(sizes, budget, entropy_share, max_repeats).select(
        F.col("source").alias("s"),
        "weight",
        F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0)).cast("long").alias("whole"),
        F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(F.lit(0)).cast("long").alias("rest"),
        F.greatest(F.ceil(F.col("tokens") / F.lit(block_tokens)), F.lit(1)).cast("long").alias("blocks"),
    )
    dealt = sizes.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    dealt = dealt.withColumn("block", F.pmod(_order(seed, F.col("doc_id")), F.col("blocks")))
    last = _order(seed, F.col("whole"), F.col("source"), F.col("block"))  # the blocks' order in the last, partial pass
    blocks = dealt.groupBy("source", "block", "whole", "rest").agg(F.sum("n_tokens").alias("tokens"))
    # Sources have any number of blocks, so the running total does not gather them.
    blocks = running(blocks, ["source"], [last, F.col("block")], {"upto": Total("sum", F.col("tokens"))})
    blocks = blocks.withColumn("before", F.col("upto") - F.col("tokens")).select(
        F.col("source").alias("s"),
        F.col("block").alias("b"),
        (F.col("before") + F.col("tokens") <= F.col("rest")).alias("inside"),
        F.when((F.col("before") < F.col("rest")) & (F.col("before") + F.col("tokens") > F.col("rest")), F.col("rest") - F.col("before")).alias("room"),
    )
    dealt = dealt.join(blocks, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).drop("s", "b")
    # Where a budget ends: the documents of that one block, until it is full.
    cut = dealt.where("room is not null")
    inner = Window.partitionBy("source", "block").orderBy(_order(seed, F.col("whole"), F.col("doc_id")), "doc_id", "n_tokens")
    inner = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = cut.withColumn("inside", F.sum("n_tokens").over(inner) <= F.col("room"))
    placed = dealt.where("room is null").unionByName(ended)
    passes = placed.withColumn("passes", F.col("whole") + (F.col("inside") & (F.col("rest") > 0)).cast("long")).where("passes > 0")
    each = passes.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)))
    return each.select(
        "doc_id",
        "source",
        "n_tokens",
        "weight",
        "pass",
        "block",
        _order(seed, F.col("pass"), F.col("source"), F.col("block")).alias("block_order"),
        _order(seed, F.col("pass"), F.col("doc_id")).alias("doc_order"),
    )
