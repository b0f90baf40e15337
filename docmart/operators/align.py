"""Schema alignment and union."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart.functions.casts import cast_leniently
from docmart.functions.schema import table_schema
from docmart.plans.config import Routing


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    Values are cast leniently, missing columns become typed nulls, further
    columns are dropped; one projection.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for target in schema.fields:
        if target.name in have:
            value = cast_leniently(F.col(f"`{target.name}`"), have[target.name], target.dataType)
        else:
            value = F.lit(None)
        columns.append(value.cast(target.dataType).alias(target.name))
    return df.select(*columns)


def align_to_types(df: DataFrame, types: Mapping[str, Any]) -> DataFrame:
    return align(df, table_schema(types))


def union_all(frames: Iterable[DataFrame | None]) -> DataFrame | None:
    """Union of the frames that exist: by name, all columns, duplicates kept."""
    present = [f for f in frames if f is not None]
    if not present:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def combine_domains(frames: Mapping[str, DataFrame | None], routing: Routing) -> dict[str, DataFrame]:
    """Config-keyed frames to domain-keyed frames of the declared schema.

    All configs of a domain are united. Each is aligned first, so that text and
    numbers of one column never meet uncast.
    """
    pieces: dict[str, list[DataFrame]] = {}
    for config, frame in frames.items():
        table = routing.table(config)
        if frame is not None and table is not None:
            pieces.setdefault(routing.domain(config), []).append(align(frame, routing.schema(table)))
    return {domain: reduce(DataFrame.union, aligned) for domain, aligned in pieces.items()}
