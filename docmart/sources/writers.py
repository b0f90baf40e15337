"""Sinks. One distributed write per table; there is no file per document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart.operators.extract import extract, lookup_columns
from docmart.operators.lookup import apply_lookups
from docmart.plans.config import DomainConfig
from docmart.session import delete_path, path_exists

CSV_LINE_END = "\r\n"
# Pandas-compatible CSV text: quotes are doubled, null is an empty cell.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "emptyValue": "",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


@dataclass(frozen=True)
class WriteResult:
    name: str
    path: str
    rows: int | None
    error: str | None = None


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), max_rows_per_file: int = 0) -> None:
    """One Parquet table. The document id is a column of it, not a file per document."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_each(
    frames: Mapping[str, DataFrame],
    base: str,
    suffix: str = ".parquet",
    fmt: str = "parquet",
    at_once: int = 4,
    max_rows_per_file: int = 0,
    expected: Mapping[str, int] | None = None,
) -> list[WriteResult]:
    """Write ``{base}/{name}{suffix}`` per frame; a failing one is reported, the rest go on.

    Up to ``at_once`` write jobs are submitted together, so that the last tasks of
    one table do not leave the cluster idle. Rows are counted while they are written.
    With ``expected`` a table of another number of rows is reported as failed.
    """

    def write(item: tuple[str, DataFrame]) -> WriteResult:
        name, frame = item
        path = f"{base.rstrip('/')}/{name}{suffix}"
        try:
            seen = Observation()
            counted = frame.observe(seen, F.count(F.lit(1)).alias("rows"))
            if fmt == "csv":
                write_csv(counted, path)
            else:
                write_table(counted, path, max_rows_per_file=max_rows_per_file)
            rows = seen.get["rows"]
            wanted = (expected or {}).get(name, rows)
            return WriteResult(name, path, rows, None if rows == wanted else f"wrote {rows} of {wanted} rows")
        except Exception as e:  # noqa: BLE001 - any failure of one table must not stop the others
            return WriteResult(name, path, None, f"{type(e).__name__}: {e}")

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(write, frames.items()))


def write_domains(frames: Mapping[str, DataFrame], base: str) -> list[WriteResult]:
    """One ``{domain}_parquet`` folder per domain."""
    return write_each(frames, base, suffix="_parquet")


def write_csv_per_document(df: DataFrame, path: str, by: str = "doc_id") -> None:
    """One folder per document with its CSV; for comparing small corpora by eye.

    The rows of a document come out of one exploded row, so they sit in one task
    already and no shuffle gathers them.
    """
    df.write.mode("overwrite").partitionBy(by).options(**CSV_OPTIONS).option("lineSep", CSV_LINE_END).csv(path)


def _csv_cell(c):
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(c.rlike(r'[",\r\n]'), quoted).otherwise(F.coalesce(c, F.lit("")))


def document_csv(
    parsed: DataFrame,
    config: DomainConfig,
    codemap: DataFrame | None = None,
    parsed_for: Sequence[DomainConfig] | None = None,
) -> DataFrame:
    """The CSV text of one config for every document: ``file_name, csv``.

    The scalable form of a CSV file per document: same names and content, packed
    as rows. Documents without data have no row. ``codemap`` is unique, and needed
    where the config looks codes up. Lines are gathered per document, so a group is
    bounded by what a document holds.
    """
    if lookup_columns([config]) and codemap is None:
        raise ValueError(f"{config.name} looks codes up: give a codemap")
    records = apply_lookups(extract(parsed, [config], parsed_for, place=True), [config], codemap)
    cells = [_csv_cell(F.col(f"`{f.out}`").cast("string")) for f in config.fields]
    line = F.concat(F.concat_ws(",", *cells), F.lit(CSV_LINE_END))
    lines = records.groupBy("__file").agg(F.array_sort(F.collect_list(F.struct("__place", line.alias("line")))).alias("lines"))
    header = ",".join(f.out for f in config.fields) + CSV_LINE_END
    text = F.concat(F.lit(header), F.array_join(F.col("lines.line"), ""))
    return lines.select(F.concat("__file", F.lit(f"__{config.name}.csv")).alias("file_name"), text.alias("csv"))


def compact(
    spark: SparkSession, source: str, target: str, schema: T.StructType, files: int | None = None, drop_source: bool = False
) -> int:
    """Rewrite a folder of small files as one table; returns its rows.

    The file source packs small files into ``spark.sql.files.maxPartitionBytes``
    splits and each split becomes one file; ``files`` lowers that further. The
    source is dropped only after the target has been counted against it.
    """
    before = spark.read.schema(schema).parquet(source)
    (before.coalesce(files) if files else before).write.mode("overwrite").parquet(target)
    rows = spark.read.schema(schema).parquet(target).count()
    if drop_source:
        expected = before.count()
        if rows != expected:
            raise RuntimeError(f"compacted {rows} of {expected} rows; {source} is kept")
        delete_path(spark, source)
    return rows


def compact_tables(
    spark: SparkSession, base: str, schemas: Mapping[str, T.StructType], files: int | None = None, drop_source: bool = True
) -> list[WriteResult]:
    """``{base}/{table}`` to ``{base}/{table}.parquet`` for the known tables only.

    Folders that are not declared tables are left alone, and a rerun finds
    nothing left to do.
    """
    results = []
    for table, schema in schemas.items():
        source, target = f"{base.rstrip('/')}/{table}", f"{base.rstrip('/')}/{table}.parquet"
        if not path_exists(spark, source):
            continue
        try:
            results.append(WriteResult(table, target, compact(spark, source, target, schema, files, drop_source)))
        except Exception as e:  # noqa: BLE001 - any failure of one table must not stop the others
            results.append(WriteResult(table, target, None, f"{type(e).__name__}: {e}"))
    return results


def count_output_files(spark: SparkSession, base: str, pattern: str = "*.parquet") -> DataFrame:
    """Data files below ``base``, at any depth. File contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(base)
    )
    return files.select("path").agg(F.count(F.lit(1)).alias("n_files"))
