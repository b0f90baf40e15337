"""Running totals and packing by size over groups of any size.

A plain window puts all rows of a group into one task. Here the rows are dealt by ranges of
``(group, order)`` with sampled bounds, so a group spreads over as many tasks as its share of
the rows asks for. Each range is totalled on its own; what came before a range is then added
from a table of one row per range and group, which is all that meets per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmart.session import scratch_path


class Total(NamedTuple):
    """An associative running value: ``how`` is ``sum``, ``xor``, ``max`` or ``last``; null values
    add nothing (``last`` is the latest value that is not null). Sums start at zero, the others at null."""

    how: str
    value: Column


_WITHIN = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "xor": lambda c: F.coalesce(F.bit_xor(c), F.lit(0)),
    "max": F.max,
    "last": lambda c: F.last(c, ignorenulls=True),
}
_JOIN = {
    "sum": lambda carry, own: F.coalesce(carry, F.lit(0)) + own,
    "xor": lambda carry, own: F.coalesce(carry, F.lit(0)).bitwiseXOR(own),
    "max": lambda carry, own: F.greatest(carry, own),
    "last": lambda carry, own: F.coalesce(own, carry),
}


def _over(total: str, c: str, window) -> Column:
    if total in ("sum", "xor"):
        plain = F.sum(c) if total == "sum" else F.bit_xor(c)
        return F.coalesce(plain.over(window), F.lit(0))
    return (F.max(c) if total == "max" else F.last(c, ignorenulls=True)).over(window)


def running(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], totals: Mapping[str, Total], tasks: int | None = None
) -> DataFrame:
    """``df`` with a column per running total, its own row included.

    ``order`` should tell rows of a group apart: rows that tie in all of it lie in one range. The
    dealt rows are written to the shared folder, so that their ranges are the same for all that
    follows and survive lost executors; keep ``df`` narrow. ``tasks`` is the number of ranges
    (default: ``spark.sql.shuffle.partitions``). A null in ``group`` is a group of its own.
    """
    spark = df.sparkSession
    values = {f"__v{i}": t for i, t in enumerate(totals.values())}
    keys = [F.col(g) for g in group]
    dealt = df.select("*", *[c.alias(f"__o{i}") for i, c in enumerate(order)], *[t.value.alias(v) for v, t in values.items()])
    names = [f"__o{i}" for i in range(len(order))]
    n = [tasks] if tasks else []
    path = scratch_path(spark, "ranges")
    dealt.write.parquet(f"{path}/rows")  # sampling the bounds would else make the rows a second time
    rows = spark.read.schema(dealt.schema).parquet(f"{path}/rows")
    rows.repartitionByRange(*n, *keys, *names).withColumn("__range", F.spark_partition_id()).write.parquet(f"{path}/ranges")
    rows = spark.read.parquet(f"{path}/ranges").withColumn("__group", F.struct(F.lit(0).alias("_"), *keys))

    within = Window.partitionBy("__range", "__group").orderBy(*names).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"__t{i}": _over(t.how, v, within) for i, (v, t) in enumerate(values.items())})
    # ``last`` needs the order inside a range as well: the latest value by its place.
    latest = F.struct(*names)
    parts = []
    for i, (v, t) in enumerate(values.items()):
        if t.how == "last":
            part = F.max_by(v, F.when(F.col(v).isNotNull(), latest))
        else:
            part = _WITHIN[t.how](v)
        parts.append(part.alias(f"__p{i}"))
    ranges = rows.groupBy("__range", "__group").agg(*parts)
    before = Window.partitionBy("__group").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = [_over(t.how, f"__p{i}", before).alias(f"__c{i}") for i, t in enumerate(values.values())]
    shifts = ranges.select(F.col("__range").alias("__r"), F.col("__group").alias("__g"), *carried)
    # A left join: an inner one would add a null filter to one side only and keep the two from
    # sharing the shuffle.
    both = local.join(shifts, (F.col("__range") == F.col("__r")) & (F.col("__group") == F.col("__g")), "left")
    out = [_JOIN[t.how](F.col(f"__c{i}"), F.col(f"__t{i}")).alias(name) for i, (name, t) in enumerate(totals.items())]
    return both.select(*[F.col(f"`{c}`") for c in df.columns], *out)


def pack(df: DataFrame, size: Column, key: str, load: int) -> DataFrame:
    """Rows cut into loads of about ``load`` bytes, one task each.

    The running total of ``size``, in the order of a hash of ``key``, is cut every ``load`` bytes; a
    row goes where its middle falls. No load exceeds ``load`` by more than its largest row, and a row
    of ``load`` bytes and more has one nearly to itself, however large and small rows are mixed. Only
    ``key`` and sizes are ordered; the rows themselves move once. ``key`` must be unique.
    """
    sizes = df.select(F.col(key).alias("__key"), F.coalesce(size, F.lit(0)).cast("long").alias("__size"))
    text = F.col("__key").cast("string").cast("binary")
    so_far = running(sizes, [], [F.md5(text), F.col("__key")], {"__end": Total("sum", F.col("__size"))})
    cut = so_far.select("__key", F.floor((F.col("__end") - F.col("__size") / 2) / load).cast("int").alias("__load"))
    n = (cut.agg(F.max("__load")).first()[0] or 0) + 1
    loaded = df.join(cut, df[key].eqNullSafe(F.col("__key")), "left").withColumn("__load", F.coalesce("__load", F.lit(0)))
    return loaded.repartitionById(n, F.col("__load")).drop("__key", "__load")
