"""Run reports: status lines, counts, histograms, shapes and probes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmart.operators.running import Total, running
from docmart.plans.config import DomainConfig, Routing

OK, ERROR = "OK", "ERROR"

# ``counted`` frames come from ``with_counts``: doc_id, file_name, error, counts.


def _count(config: DomainConfig) -> Column:
    return F.col("counts").getField(config.name)


def table_counts_per_document(counted: DataFrame, configs: Sequence[DomainConfig], routing: Routing) -> DataFrame:
    """``doc_id, table, n`` for every pair with rows; a projection, no shuffle."""
    pairs = [F.struct(F.lit("").alias("table"), F.lit(0).cast("bigint").alias("n"))]
    for table, members in routing.tables(configs).items():
        total = sum((F.coalesce(_count(c), F.lit(0)) for c in members), F.lit(0).cast("bigint"))
        pairs.append(F.struct(F.lit(table).alias("table"), total.alias("n")))
    present = F.filter(F.array(*pairs), lambda p: p["n"] > 0)
    return counted.select("doc_id", F.inline(present))


def config_counts(counted: DataFrame, configs: Sequence[DomainConfig]) -> DataFrame:
    """``config, n``: rows per config, also for configs without a table or without rows."""
    totals = counted.agg(*[F.coalesce(F.sum(_count(c)), F.lit(0)).alias(c.name) for c in configs])
    pairs = [F.struct(F.lit(c.name).alias("config"), F.col(f"`{c.name}`").alias("n")) for c in configs]
    return totals.select(F.inline(F.array(*pairs)))


def table_counts(counted: DataFrame, configs: Sequence[DomainConfig], routing: Routing) -> DataFrame:
    """``table, n`` for the tables with rows; empty ones are absent."""
    tables = routing.tables(configs)
    sums = [
        sum((F.coalesce(F.sum(_count(c)), F.lit(0)) for c in members), F.lit(0).cast("bigint")).alias(table)
        for table, members in tables.items()
    ]
    pairs = [F.struct(F.lit(t).alias("table"), F.col(f"`{t}`").alias("n")) for t in tables]
    if not tables:
        return counted.select(F.lit("").alias("table"), F.lit(0).cast("bigint").alias("n")).where(F.lit(False))
    return counted.agg(*sums).select(F.inline(F.array(*pairs))).where("n > 0")


def run_status(
    counted: DataFrame, configs: Sequence[DomainConfig], routing: Routing, failed: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per (document, table) with rows, and one per unreadable document.

    A document is converted whole or not at all. ``failed`` has the tables that could not be
    written, with the reason: their documents get an error for the table.
    """
    none = F.lit(None).cast("string")
    done = []
    for table, members in routing.tables(configs).items():
        has_rows = F.coalesce(*[_count(c) for c in members]).isNotNull()
        reason = (failed or {}).get(table)
        status, message = (OK, none) if reason is None else (ERROR, F.lit(f"table {table} not written: {reason}"))
        entry = F.struct(F.lit(status).alias("status"), F.lit(table).alias("table"), message.alias("message"))
        done.append(F.when(has_rows, entry))
    failed = F.array(F.struct(F.lit(ERROR).alias("status"), none.alias("table"), F.col("error").alias("message")))
    entries = F.when(F.col("error").isNotNull(), failed).otherwise(F.array_compact(F.array(*done)))
    return counted.select("doc_id", "file_name", F.inline(entries))


def status_line() -> Column:
    """The log line of a :func:`run_status` row."""
    ok = F.concat(F.lit("OK: "), F.col("doc_id"), F.lit(" -> "), F.col("table"))
    # Files of many documents name the file alone; a message on a line of its own would be a line.
    error = F.concat(F.lit("ERROR: "), F.col("file_name"), F.lit(" :: "), F.regexp_replace("message", r"[\r\n]+", " | "))
    return F.when(F.col("status") == OK, ok).otherwise(error)


def status_counts(lines: DataFrame, line: str = "line") -> DataFrame:
    """Log lines by leading label; both labels are present, also at zero."""
    c = F.col(line)
    totals = lines.agg(
        F.count_if(c.startswith("OK:")).alias("ok"), F.count_if(c.startswith("ERROR:")).alias("error")
    )
    pairs = F.array(
        F.struct(F.lit(OK).alias("status"), F.col("ok").alias("n")),
        F.struct(F.lit(ERROR).alias("status"), F.col("error").alias("n")),
    )
    return totals.select(F.inline(pairs))


def error_histogram(lines: DataFrame, line: str = "line") -> DataFrame:
    """Error messages without their document, by falling count."""
    errors = lines.where(F.col(line).startswith("ERROR:"))
    message = F.regexp_replace(line, r"^ERROR: .* :: ", "")
    return (
        errors.groupBy(message.alias("message"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "message")
    )


def ok_pairs(status: DataFrame) -> DataFrame:
    """(document, table) pairs that yielded rows, and the unreadable documents."""
    return status.select("doc_id", F.coalesce("table", F.concat(F.lit("quarantine: "), "message")).alias("outcome"))


def running_total(df: DataFrame, group: str, key: str, value: str, tasks: int | None = None) -> DataFrame:
    """``group, key, value`` with the ``running`` sum so far and the ``position``.

    The order within a group is by ``(md5(key), key)``. A group of any size spreads over ranges
    of that order (:func:`docmart.operators.running.running`); ``tasks`` is their number.
    """
    narrow = df.select(group, key, value)
    order = [F.md5(F.col(key).cast("binary")), F.col(key)]
    totals = {"running": Total("sum", F.col(value)), "position": Total("sum", F.lit(1).cast("bigint"))}
    return running(narrow, [group], order, totals, tasks)


def shape_log(counted: DataFrame, configs: Sequence[DomainConfig]) -> DataFrame:
    """Per (document, config): shape of the piece and of the config so far.

    Readable documents only. A pair without data has null counts. ``configs_seen``
    counts the configs met so far: all of them after the first document. Documents
    count in the order of :func:`running_total`.
    """
    entries = [F.struct(F.lit(c.name).alias("config"), _count(c).alias("n_rows")) for c in configs]
    pairs = counted.select("doc_id", F.inline(F.when(F.col("error").isNull(), F.array(*entries))))
    logged = running_total(pairs, "config", "doc_id", "n_rows")
    width = ordinal = F.lit(None).cast("int")
    for i, c in enumerate(configs, start=1):
        this = F.col("config") == c.name
        width = F.when(this, F.lit(len(c.fields))).otherwise(width)
        ordinal = F.when(this, F.lit(i)).otherwise(ordinal)
    has_data = F.col("n_rows").isNotNull()
    return logged.select(
        "doc_id",
        "config",
        "n_rows",
        F.when(has_data, width).alias("n_columns"),
        F.when(has_data, F.col("running")).alias("running_rows"),
        F.when(F.col("position") == 1, ordinal).otherwise(F.lit(len(configs))).alias("configs_seen"),
    )


def preview(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """First ``n`` rows in a given order; runs as a top-n, not a full sort."""
    return df.orderBy(*order).limit(n)


def column_probe(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """First value of a column in a given order, and the column's type."""
    first = F.min_by(F.struct(F.col(column).alias("v")), F.struct(*order))["v"]
    return df.agg(
        F.lit(column).alias("column"),
        first.cast("string").alias("first_value"),
        F.lit(df.schema[column].dataType.simpleString()).alias("type"),
    )
