"""Declared column types and table schemas."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from typing import Any

import numpy as np
from pyspark.sql import types as T

# The declared types and the column type each stands for. Anything
# else, ``str`` included, is text.
DECLARED_TYPES: dict[Any, T.DataType] = {
    np.int64: T.LongType(),
    np.int32: T.IntegerType(),
    np.float64: T.DoubleType(),
    np.float32: T.FloatType(),
    datetime.datetime: T.TimestampType(),
    datetime.date: T.DateType(),
    str: T.StringType(),
}

_BY_NAME = {t.__name__: t for t in DECLARED_TYPES}


def _canonical(declared: Any) -> Any:
    if isinstance(declared, np.dtype):
        return declared.type
    if isinstance(declared, str):
        return _BY_NAME.get(declared)
    return declared


def is_known_type(declared: Any) -> bool:
    key = _canonical(declared)
    return isinstance(key, type) and key in DECLARED_TYPES


def spark_type(declared: Any) -> T.DataType:
    """Column type of a declared type, given as a class, a numpy dtype or a name."""
    if is_known_type(declared):
        return DECLARED_TYPES[_canonical(declared)]
    return T.StringType()


def table_schema(types: Mapping[str, Any]) -> T.StructType:
    """Schema in declaration order; every column is nullable."""
    return T.StructType([T.StructField(name, spark_type(t), True) for name, t in types.items()])
