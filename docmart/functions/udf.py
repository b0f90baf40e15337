"""Vectorised user functions: the extension point for rules no expression can state.

Native expressions are preferred throughout the library (``plus_one`` is just
``col + 1``); a rule that needs Python runs over Arrow batches, never row by row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def vectorised(return_type: str) -> Callable[[Callable[[pd.Series], pd.Series]], Callable[..., Column]]:
    """Decorator: a ``Series -> Series`` function as a Column function."""

    def wrap(fn: Callable[[pd.Series], pd.Series]) -> Callable[..., Column]:
        def series_to_series(values: pd.Series) -> pd.Series:
            return fn(values)

        return F.pandas_udf(series_to_series, return_type)

    return wrap


def isolated(return_type: str) -> Callable[[Callable[[pd.Series], pd.Series]], Callable[..., Column]]:
    """Decorator: a ``Series -> Series`` function as a Column function that gives ``struct<value, error>``.

    A batch runs at once. Only if it raises is it halved down to the first value that raises, so that
    a value which cannot be computed is null, with the exception's text from its own call, and no
    other is touched. What follows runs in parts as long as the stretches between raising values have
    been, each halved in the same way if it raises. A result that does not fit ``return_type``, or of
    another length, counts as raised.
    """

    def wrap(fn: Callable[[pd.Series], pd.Series]) -> Callable[..., Column]:
        def checked(values: pd.Series, kind: pa.DataType) -> list:
            found = fn(values)
            if len(found) != len(values):
                raise ValueError(f"{len(found)} results for {len(values)} values")
            if isinstance(found, pd.Series) and isinstance(found.dtype, np.dtype):
                found = found.to_numpy()  # the same values; Arrow takes small arrays faster than small series
            return pa.array(found, type=kind, from_pandas=True).to_pylist()

        def column(c: Column) -> Column:
            kind = to_arrow_type(T.StructType.fromDDL(f"value {return_type}")[0].dataType)

            def series_to_frame(values: pd.Series) -> pd.DataFrame:
                value: list = [None] * len(values)
                error: list = [None] * len(values)
                n, lo, raised = len(values), 0, 0
                step, known = n, 0  # size of the next part; a value before ``known`` raises
                while lo < n:
                    hi = (lo + known + 1) // 2 if known > lo else min(lo + step, n)
                    try:
                        value[lo:hi] = checked(values.iloc[lo:hi], kind)
                    except Exception as e:  # noqa: BLE001 - some value of the part: found out by halves
                        known = hi
                        if hi - lo == 1:
                            error[lo] = f"{type(e).__name__}: {e}"
                            lo, raised = hi, raised + 1
                            step = max(1, 7 * lo // (10 * raised))  # about as likely clean as not
                        continue
                    if known <= lo:
                        step *= 2
                    lo = hi
                return pd.DataFrame({"value": pd.Series(value, dtype=object), "error": pd.Series(error, dtype=object)})

            return F.pandas_udf(series_to_frame, f"value {return_type}, error string")(c)

        return column

    return wrap


def _plus_one(values: pd.Series) -> pd.Series:
    return values + 1


def plus_one(c: Column) -> Column:
    """Add one to a whole-number column, through Arrow batches."""
    return vectorised("long")(_plus_one)(c)
