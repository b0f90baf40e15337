"""Code lookup: source code to standard concept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmart.functions.casts import to_int
from docmart.operators.extract import lookup_columns, lookup_keys
from docmart.operators.skew import SHARE, heavy_keys, split_join
from docmart.plans.config import DomainConfig


def unique_codemap(codemap: DataFrame) -> DataFrame:
    """One concept per (code_system, code); of several the largest is kept.

    Grouped with a map-side combine, so a code with many copies costs one row per
    input partition. The key is grouped as one struct: its partitioning then does
    not serve a join on the two columns, so that join has a shuffle of its own on
    this side as well, without which AQE would not split hot codes.
    """
    key = F.struct("code_system", "code")
    return (
        codemap.where(F.col("code_system").isNotNull() & F.col("code").isNotNull())
        .groupBy(key.alias("key"))
        .agg(F.max("concept_id").alias("concept_id"))
        .select("key.code_system", "key.code", "concept_id")
    )


def lookup(df: DataFrame, codemap: DataFrame, system: str, code: str, out: str) -> DataFrame:
    """Left outer equi-join: every row is kept, ``out`` is null where no code matches.

    ``codemap`` must be unique (:func:`unique_codemap`). There is no broadcast
    hint: Catalyst broadcasts the codemap while its size is below
    ``spark.sql.autoBroadcastJoinThreshold``; a larger one is joined by shuffle,
    where AQE splits the partitions of hot codes.
    """
    keys = codemap.select(
        F.col("code_system").alias("__k_system"), F.col("code").alias("__k_code"), F.col("concept_id").alias(out)
    )
    # Rows without a code match nothing; a key of their own keeps them from meeting in one task.
    alone = F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string"))
    keyed = df.withColumn("__code", F.coalesce(F.col(code), alone))
    on = (F.col(system) == F.col("__k_system")) & (F.col("__code") == F.col("__k_code"))
    return keyed.join(keys, on, "left").drop("__k_system", "__k_code", "__code")


def lookup_split(df: DataFrame, codemap: DataFrame, system: str, code: str, out: str, share: int = SHARE) -> DataFrame:
    """The same as :func:`lookup` for a codemap too large to broadcast and codes as hot as you like.

    Codes that hold more than one in ``share`` rows of ``df`` are counted first; their few concepts are
    broadcast, and those rows are not shuffled. All others are, and none of them is hot. ``df`` is read
    three times: it should be a stored table. Rows without a code stay where they are too.
    """
    keys = codemap.select(F.col("code_system").alias("__system"), F.col("code").alias("__code"), F.col("concept_id").alias(out))
    coded = df.withColumns({"__system": F.col(system), "__code": F.col(code)})
    known = coded.where(F.col("__system").isNotNull() & F.col("__code").isNotNull())
    unknown = coded.where(F.col("__system").isNull() | F.col("__code").isNull())
    found = split_join(known, keys, ["__system", "__code"], heavy_keys(known, ["__system", "__code"], share))
    rest = unknown.withColumn(out, F.lit(None).cast(keys.schema[out].dataType))
    return found.unionByName(rest).drop("__system", "__code")


def apply_lookups(records: DataFrame, configs: Sequence[DomainConfig], codemap: DataFrame, split: bool = False) -> DataFrame:
    """Resolve every lookup column of extracted records, with the configs' defaults; with ``split``
    hot codes are split off (:func:`lookup_split`)."""
    for out in lookup_columns(configs):
        system, code, default = lookup_keys(out)
        # Other configs of the table may read the same column from a path.
        read = [F.col(out)] if out in records.columns else []
        found = (lookup_split if split else lookup)(records, codemap, system, code, "__found")
        value = F.coalesce("__found", *[to_int(c) for c in (F.col(default), *read)])
        records = found.withColumn(out, value).drop("__found", system, code, default)
    return records


def code_misses(codes: DataFrame, codemap: DataFrame) -> DataFrame:
    """Codes without a concept and how often each occurs.

    ``codes`` has ``code_system, code``. Occurrences are counted before the
    anti-join, so the join sees each code once however hot it is.
    """
    counted = (
        codes.where(F.col("code").isNotNull())
        .groupBy("code_system", "code")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = codemap.select("code_system", "code")
    return counted.join(known, ["code_system", "code"], "left_anti")
