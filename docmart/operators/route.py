"""Routing of configs to domains and tables, as data."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.plans.config import DomainConfig, Routing

_ROUTES = "config string, domain string, table string"


def routes_frame(spark: SparkSession, configs: Sequence[DomainConfig], routing: Routing) -> DataFrame:
    """One row per config; ``domain`` and ``table`` are null where unmapped.

    Built from the declarations: its size is the number of configs, whatever the
    size of the corpus.
    """
    rows = [(c.name, routing.domain(c.name), routing.table(c.name)) for c in configs]
    return spark.createDataFrame(rows, _ROUTES)


def route(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Attach ``domain`` and ``table`` to rows with a ``config``; unmapped rows drop out."""
    mapped = routes.where(F.col("table").isNotNull())
    return df.join(mapped, "config", "inner")


def unrouted(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Rows whose config has no table: reported, never lost silently."""
    mapped = routes.where(F.col("table").isNotNull()).select("config")
    return df.join(mapped, "config", "left_anti")


def filter_domains(df: DataFrame, include: Iterable[str] | None = None, exclude: Iterable[str] = ()) -> DataFrame:
    """Keep rows by their ``domain``."""
    if include is not None:
        df = df.where(F.col("domain").isin(list(include)))
    excluded = list(exclude)
    return df.where(~F.col("domain").isin(excluded)) if excluded else df
