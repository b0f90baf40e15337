"""Codemap, stored tables and frames made of literals."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docmart.functions.schema import table_schema
from docmart.session import path_exists

CODEMAP_SCHEMA = "code_system string, code string, concept_id bigint"


def read_codemap(spark: SparkSession, path: str) -> DataFrame:
    """Codemap CSV with a header; a concept that is no number reads as null."""
    return spark.read.schema(CODEMAP_SCHEMA).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_tables(
    spark: SparkSession,
    base: str,
    names: Iterable[str],
    schemas: Mapping[str, T.StructType] | None = None,
    suffix: str = ".parquet",
) -> dict[str, DataFrame]:
    """The named tables below ``base``. With a declared schema nothing is inferred.

    Tables that were never written, because they had no rows, are left out.
    """
    schemas = schemas or {}
    paths = {name: f"{base.rstrip('/')}/{name}{suffix}" for name in names}
    return {n: read_table(spark, p, schemas.get(n)) for n, p in paths.items() if path_exists(spark, p)}


def typed_frame(spark: SparkSession, rows: Sequence[Any], types: Mapping[str, Any]) -> DataFrame:
    """Small local rows under a declared schema (settings, code lists)."""
    return spark.createDataFrame(list(rows), table_schema(types))


def literal_rows(spark: SparkSession, rows: Sequence[Any]) -> DataFrame:
    """Small local rows with an inferred schema."""
    return spark.createDataFrame(list(rows))
