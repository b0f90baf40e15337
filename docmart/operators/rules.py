"""Extraction by a user's Python function, with one fate per document.

A rule takes a file name and a document's text and gives records by config: dictionaries, or a pandas
frame. It runs over Arrow batches inside Spark tasks. A document whose rule raises, or whose result is
not of that form, is set aside with the exception's text; every other document of its batch and task
goes on. What comes out has the shape of parsed documents (``doc_id, file_name, error, xml, counts``), so
that routing, tables, quarantine, status and all reports work as for declared extraction.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart.functions.names import doc_id
from docmart.operators.extract import CONFIG
from docmart.operators.parse import UNREADABLE_DOCUMENT
from docmart.plans.config import DomainConfig, from_path

Rule = Callable[[str, str], Mapping[str, Iterable[Mapping[str, Any]]] | None]
SEND_BYTES = 1 << 23
RECORDS = "records"


def rule_config(name: str, columns: Sequence[str]) -> DomainConfig:
    """Declares what a rule gives under ``name``: its columns, all text until they are cast."""
    return DomainConfig(name, tuple(from_path(c, c) for c in columns))


def columns_of(config: DomainConfig) -> list[str]:
    return [f.out for f in config.fields]


def as_text(value: Any) -> str | None:
    """A cell as text, the form in which the lenient casts read it; NaN and NaT are null."""
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def _rows(found: Any, names: list[str]) -> list[dict[str, str | None]]:
    if isinstance(found, pd.DataFrame):
        found = found.to_dict("records")
    out = []
    for record in found:
        if not isinstance(record, Mapping):
            raise TypeError(f"a record is a {type(record).__name__}, not a mapping")
        out.append({n: as_text(record.get(n)) for n in names})
    return out


def apply_rule(rule: Rule, names: dict[str, list[str]], file_name: str, xml: str | None) -> tuple[dict, str | None]:
    """The records of one document by config, or why there are none."""
    if xml is None:
        return {}, UNREADABLE_DOCUMENT
    try:
        found = rule(file_name, xml)
        if found is not None and not isinstance(found, Mapping):
            raise TypeError(f"the rule gave a {type(found).__name__}, not a mapping of configs")
        unknown = sorted(map(str, set(found or {}) - set(names)))
        if unknown:
            raise KeyError(f"not declared: {', '.join(unknown)}")
        return {c: _rows(r, names[c]) for c, r in (found or {}).items() if r is not None}, None
    except Exception as e:  # noqa: BLE001 - whatever a rule does to one document must not reach another
        return {}, f"{type(e).__name__}: {e}"


def run_rule(corpus: DataFrame, rule: Rule, configs: Sequence[DomainConfig]) -> DataFrame:
    """``file_name, xml`` to ``doc_id, file_name, error, xml, records, counts``.

    ``records`` holds an array of records per config, ``counts`` their number, null where there are
    none; ``xml`` stays with refused documents only. Python runs each time the frame is read: store it
    (``convert_by_rule`` does) if more than one table or report is made of it.
    """
    names = {c.name: columns_of(c) for c in configs}
    record = {c: T.StructType([T.StructField(n, T.StringType()) for n in ns]) for c, ns in names.items()}
    records = T.StructType([T.StructField(c, T.ArrayType(r)) for c, r in record.items()])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("file_name", "error", "xml")] + [T.StructField(RECORDS, records)])
    cell = pa.struct([(c, pa.list_(pa.struct([(n, pa.string()) for n in ns]))) for c, ns in names.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), (pa.string(),) * 3 + (cell,), strict=True)]
            return pa.record_batch(columns, names=schema.names)

        for part in batches:
            for name, xml in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                text = xml.as_py()
                found, error = apply_rule(rule, names, name, text)
                held.append((name, error, text if error else None, {c: found.get(c) or None for c in names}))
                size += len(text or "")
                if size >= SEND_BYTES:
                    yield batch()
                    held.clear()
                    size = 0
        if held:
            yield batch()

    done = corpus.select("file_name", "xml").mapInArrow(run, schema)
    counts = [F.array_size(F.col(RECORDS)[c]).cast("bigint").alias(c) for c in names]
    return done.select(doc_id(F.col("file_name")).alias("doc_id"), "file_name", "error", "xml", RECORDS, F.struct(*counts).alias("counts"))


def rule_records(done: DataFrame, configs: Sequence[DomainConfig]) -> DataFrame:
    """Records of several configs as text columns with their ``doc_id`` and ``config``, by one
    generator. A column that a config does not declare is null in its rows; a record without a
    ``doc_id`` of its own has its document's."""
    names = list(dict.fromkeys(n for c in configs for n in columns_of(c)))

    def array_of(config: DomainConfig) -> Column:
        own = columns_of(config)

        def make(r: Column) -> Column:
            cells = [(r[n] if n in own else F.lit(None).cast("string")).alias(f"r_{i}") for i, n in enumerate(names)]
            return F.struct(F.lit(config.name).alias("r_config"), *cells)

        return F.coalesce(F.transform(F.col(RECORDS)[config.name], make), F.array())

    arrays = [array_of(config) for config in configs]
    every = F.concat(*arrays) if len(arrays) > 1 else arrays[0]
    rows = done.select(F.col("doc_id").alias("r_doc"), F.inline(every))
    cells = {n: F.col(f"r_{i}") for i, n in enumerate(names)}
    cells["doc_id"] = F.coalesce(*([cells["doc_id"]] if "doc_id" in cells else []), "r_doc")
    return rows.select(F.col("r_config").alias(CONFIG), *[c.alias(n) for n, c in cells.items()])
