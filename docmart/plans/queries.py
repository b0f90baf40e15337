"""One runnable query per operator, over the given tables or documents made of them."""

from __future__ import annotations

import datetime
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from docmart.functions import casts
from docmart.functions.names import doc_id
from docmart.functions.udf import plus_one
from docmart.operators import report
from docmart.operators.align import align_to_types, union_all
from docmart.operators.diagnose import causes, diagnose
from docmart.operators.extract import extract, lookup_keys, with_counts
from docmart.operators.lookup import apply_lookups, code_misses, lookup, lookup_split, unique_codemap
from docmart.operators.parse import parse_documents, quarantine, read_documents
from docmart.operators.route import filter_domains, route, routes_frame, unrouted
from docmart.operators.running import pack
from docmart.plans import clinical as C
from docmart.plans.config import select_configs, without_fields
from docmart.plans.pipeline import RuleConversion, build_table, convert, convert_by_rule, convert_table
from docmart.session import scratch_path
from docmart.sources import corpus as sources
from docmart.sources import publish, tables, writers
from docmart.sources.files import write_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    # A trailing underscore keeps a query apart from the operator of its name.
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def _wall_clock(df: DataFrame) -> DataFrame:
    """Instants as wall-clock timestamps, the form in which results are compared."""
    stamps = {n: F.col(n).cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"}
    return df.withColumns(stamps) if stamps else df


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _converted(spark: SparkSession, sf: str, table: str, configs=C.CONFIGS) -> DataFrame:
    return convert_table(C.documents(spark, sf), table, configs, C.ROUTING, C.codemap(spark, sf))


def _counted(spark: SparkSession, sf: str) -> DataFrame:
    records = without_fields(C.CONFIGS)
    return with_counts(parse_documents(C.documents(spark, sf), records), records)


def _status(spark: SparkSession, sf: str) -> DataFrame:
    return report.run_status(_counted(spark, sf), C.CONFIGS, C.ROUTING)


def _status_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _status(spark, sf).select(report.status_line().alias("line"))


# ---- document tables ---------------------------------------------------------


@_query
def flagship_measurement(spark: SparkSession, sf: str) -> DataFrame:
    """Two configs into one table: parse, explode, look up, cast, align."""
    return _wall_clock(_converted(spark, sf, "measurement"))


@_query
def drug_table(spark: SparkSession, sf: str) -> DataFrame:
    return _wall_clock(_converted(spark, sf, "drug"))


@_query
def visit_table(spark: SparkSession, sf: str) -> DataFrame:
    return _wall_clock(_converted(spark, sf, "visit"))


@_query
def person_table(spark: SparkSession, sf: str) -> DataFrame:
    return _converted(spark, sf, "person")


@_query
def config_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records of one config as extracted: text, before any cast."""
    chosen = select_configs(C.CONFIGS, "results")
    records = extract(parse_documents(C.documents(spark, sf), chosen), chosen)
    return records.select("doc_id", "person_id", "visit_id", "seq", "source_code", "value", "measured_at")


@_query
def config_subset(spark: SparkSession, sf: str) -> DataFrame:
    """A named config only: the parse reads no element of the others."""
    return _wall_clock(_converted(spark, sf, "measurement", select_configs(C.CONFIGS, "vitals")))


# ---- sources -----------------------------------------------------------------


@_query
def scan_directory(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of whole XML files, several documents per file, two hops to a record; faulty
    documents lie among them."""
    path = scratch_path(spark, "batches")
    C.write_batches(spark, sf, path)
    files = sources.scan_directory(spark, path)
    parsed = parse_documents(files, [C.BATCH_VITALS])
    return _wall_clock(
        build_table(parsed, "measurement", [C.BATCH_VITALS], C.ROUTING, unique_codemap(C.codemap(spark, sf)))
    )


@_query
def scan_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """The faulty files of such a folder, empty ones too."""
    path = scratch_path(spark, "batches")
    C.write_batches(spark, sf, path)
    refused = quarantine(parse_documents(sources.scan_directory(spark, path), [C.BATCH_VITALS]))
    return refused.select("doc_id", "file_name", "message")


@_query
def rowtag_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Files of many documents, split inside the files."""
    path = scratch_path(spark, "batches")
    C.write_text(spark, sf, path)
    docs = read_documents(spark, path, C.ROOT, "id._extension", [C.RESULTS, C.VITALS])
    return docs.select(
        casts.to_int(F.col("doc_id")).alias("visit_id"),
        F.coalesce(F.array_size("doc.results"), F.lit(0)).alias("n_results"),
        F.coalesce(F.array_size("doc.vitals"), F.lit(0)).alias("n_vitals"),
        "error",
    )


@_query
def rowtag_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table from such files, faulty documents among them."""
    path = scratch_path(spark, "batches")
    C.write_text(spark, sf, path)
    docs = read_documents(spark, path, C.ROOT, "id._extension", [C.MEDICATIONS])
    codes = unique_codemap(C.codemap(spark, sf))
    return _wall_clock(build_table(docs, "drug", [C.MEDICATIONS], C.ROUTING, codes))


@_query
def packed_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A corpus stored as rows, read back and parsed."""
    path = scratch_path(spark, "packed")
    writers.write_table(C.documents(spark, sf), path)
    return parse_documents(sources.scan_packed(spark, path), [C.PATIENT]).select("doc_id", "error")


@_query
def doc_count(spark: SparkSession, sf: str) -> DataFrame:
    """The XML files of a folder, by their listing."""
    path = scratch_path(spark, "batches")
    C.write_batches(spark, sf, path)
    return sources.count_files(spark, path)


@_query
def doc_ids(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    rule = F.col("o_orderkey") % 6
    name = (
        F.when(rule == 0, F.concat(key, F.lit(".xml")))
        .when(rule == 1, F.concat(key, F.lit(".v2.xml")))
        .when(rule == 2, key)
        .when(rule == 3, F.concat(F.lit(".x"), key))
        .when(rule == 4, F.concat(key, F.lit("..xml")))
        .otherwise(F.concat(F.lit("."), key, F.lit(".xml")))
    )
    names = _table(spark, sf, "orders").select(name.alias("file_name"))
    return names.select("file_name", doc_id(F.col("file_name")).alias("doc_id"))


@_query
def literal_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Literal rows with inferred types, joined to every line."""
    rows = [Row(a=3, b=30, c="three"), Row(a=5, b=50, c="five"), Row(a=6, b=60, c="six")]
    literals = tables.literal_rows(spark, rows)
    lines = _table(spark, sf, "lineitem").groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n_lines"))
    joined = lines.join(F.broadcast(literals), F.col("l_linenumber") == F.col("a"))
    return joined.select("a", "b", "c", "n_lines")


@_query
def typed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Literal rows under a declared schema, joined to every line."""
    ranks = tables.typed_frame(spark, [("A", 1), ("N", 2), ("R", 3)], {"flag": str, "rank": np.int64})
    lines = _table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return lines.join(F.broadcast(ranks), F.col("l_returnflag") == F.col("flag")).select("flag", "rank", "n")


# ---- rules in Python ---------------------------------------------------------


def _by_rule(spark: SparkSession, sf: str) -> RuleConversion:
    return convert_by_rule(C.documents(spark, sf), C.python_rule, C.RULE_CONFIGS, C.ROUTING)


@_query
def rule_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table from a user's Python function, which raises on some documents."""
    table = _by_rule(spark, sf).table("measurement")
    return _wall_clock(table.select("doc_id", "person_id", "visit_id", "seq", "source_code", "value", "measured_at"))


@_query
def rule_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """The documents on which the function raised, with the exception's text up to the place."""
    refused = _by_rule(spark, sf).quarantine()
    return refused.select("doc_id", "file_name", F.regexp_replace("message", ": line.*$", "").alias("message"))


@_query
def rule_status(spark: SparkSession, sf: str) -> DataFrame:
    return report.status_counts(_by_rule(spark, sf).status_lines())


@_query
def guarded_udf(spark: SparkSession, sf: str) -> DataFrame:
    """A vectorised user function that raises on some values: these alone have no result. The lines
    are dealt over all cores first: a few files would otherwise leave the Python work to a few tasks."""
    lines = _table(spark, sf, "lineitem").repartition(spark.sparkContext.defaultParallelism)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", C.odd_reciprocal(F.col("l_partkey")).alias("r")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "r.value", "r.error"
    )


@_query
def error_causes(spark: SparkSession, sf: str) -> DataFrame:
    """What a strict parse says about the documents set aside."""
    return causes(diagnose(quarantine(parse_documents(C.documents(spark, sf), [C.PATIENT]))))


@_query
def error_places(spark: SparkSession, sf: str) -> DataFrame:
    """Where it says so."""
    found = diagnose(quarantine(parse_documents(C.documents(spark, sf), [C.PATIENT])))
    return found.where("message <> 'malformed XML: mismatched tag or bad character'").select("file_name", "cause", "line", (F.col("column") > 1).alias("later"))


# ---- codes -------------------------------------------------------------------


@_query
def codemap_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Codemap CSV, read back and joined to every line; default for the misses."""
    path = scratch_path(spark, "codemap")
    writers.write_csv(C.codemap(spark, sf), path)
    codes = _table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") == 7, F.lit("LOCAL")).otherwise(F.lit("PART")).alias("code_system"),
        F.col("l_partkey").cast("string").alias("code"),
    )
    found = lookup(codes, unique_codemap(tables.read_codemap(spark, path)), "code_system", "code", "concept_id")
    return found.select("l_orderkey", "l_linenumber", "code", F.coalesce("concept_id", F.lit(0)).alias("concept_id"))


@_query
def codemap_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same with hot codes split off, as for a codemap that cannot be broadcast."""
    codes = _table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") == 7, F.lit("LOCAL")).otherwise(F.lit("PART")).alias("code_system"),
        F.when(F.col("l_linenumber") < 3, F.lit("11")).when(F.col("l_linenumber") < 7, F.col("l_partkey").cast("string")).alias("code"),
    )
    found = lookup_split(codes, unique_codemap(C.codemap(spark, sf)), "code_system", "code", "concept_id")
    return found.select("l_orderkey", "l_linenumber", "code", "concept_id")


@_query
def packed_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Orders cut into loads of equal price, each one task: which order lies in which."""
    orders = _table(spark, sf, "orders").select("o_orderkey", F.floor("o_totalprice").alias("size"))
    return pack(orders, F.col("size"), "o_orderkey", 100_000_000).select("o_orderkey", F.spark_partition_id().alias("load"))


@_query
def codemap_misses(spark: SparkSession, sf: str) -> DataFrame:
    chosen = select_configs(C.CONFIGS, ["results", "vitals", "medications"])
    records = extract(parse_documents(C.documents(spark, sf), chosen), chosen)
    system, code, _ = lookup_keys("concept_id")
    codes = records.select(F.col(system).alias("code_system"), F.col(code).alias("code"))
    return code_misses(codes, C.codemap(spark, sf))


@_query
def codemap_unique(spark: SparkSession, sf: str) -> DataFrame:
    """A codemap with many copies of each code, reduced to one concept per code."""
    lines = _table(spark, sf, "lineitem").select(
        F.lit("PART").alias("code_system"),
        F.col("l_partkey").cast("string").alias("code"),
        F.col("l_suppkey").alias("concept_id"),
    )
    return unique_codemap(lines)


# ---- routing, alignment, union -----------------------------------------------


@_query
def route_tables(spark: SparkSession, sf: str) -> DataFrame:
    counts = report.config_counts(_counted(spark, sf), C.CONFIGS)
    return route(counts, routes_frame(spark, C.CONFIGS, C.ROUTING)).select("config", "domain", "table", "n")


@_query
def route_unmapped(spark: SparkSession, sf: str) -> DataFrame:
    counts = report.config_counts(_counted(spark, sf), C.CONFIGS)
    return unrouted(counts, routes_frame(spark, C.CONFIGS, C.ROUTING))


@_query
def domain_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Only the listed domains, and not the two that are left out."""
    counts = report.config_counts(_counted(spark, sf), C.CONFIGS)
    routed = route(counts, routes_frame(spark, C.CONFIGS, C.ROUTING))
    kept = filter_domains(routed, include=DOMAINS, exclude=("Visit", "Observation"))
    return kept.groupBy("domain").agg(F.sum("n").alias("n"))


# The domains that are read back.
DOMAINS = (
    "Care_Site",
    "Condition",
    "Device",
    "Drug",
    "Location",
    "Measurement",
    "Person",
    "Procedure",
    "Provider",
)


@_query
def domain_exclude(spark: SparkSession, sf: str) -> DataFrame:
    """Domains excluded before the plan is built; their rows are never formed."""
    routing = C.ROUTING.select_domains(exclude=("Visit", "Observation"))
    return report.table_counts_per_document(_counted(spark, sf), C.CONFIGS, routing)


@_query
def align_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Missing columns as typed nulls, extra columns dropped, declared order."""
    orders = _table(spark, sf, "orders").select(
        F.col("o_totalprice").alias("extra"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_custkey").cast("string").alias("person_id"),
        F.col("o_orderdate").alias("start_at"),
        F.col("o_orderkey").alias("doc_id"),
    )
    return _wall_clock(align_to_types(orders, C.ROUTING.types_of["visit"]))


@_query
def union_configs(spark: SparkSession, sf: str) -> DataFrame:
    """Records of configs with different columns, united by one generator over one parse."""
    chosen = (C.RESULTS, C.VITALS, C.MEDICATIONS, C.NOTES)
    records = extract(parse_documents(C.documents(spark, sf), chosen), chosen)
    return records.select("config", "doc_id", "source_code", "value", "quantity", "text")


@_query
def combine_domains_(spark: SparkSession, sf: str) -> DataFrame:
    """All configs of all domains from one parse: one generator, one codemap join, each row cast
    as its domain declares. Of the faulty documents only those cut off and empty lie among them."""
    chosen = (C.RESULTS, C.VITALS, C.MEDICATIONS)
    records = extract(parse_documents(C.documents(spark, sf, faults=2), chosen), chosen)
    domain = F.when(F.col("config") == C.MEDICATIONS.name, F.lit("Drug")).otherwise(F.lit("Measurement"))
    found = apply_lookups(records, chosen, unique_codemap(C.codemap(spark, sf))).withColumn("domain", domain)
    types = {"domain": str, "doc_id": str, "seq": np.int32, "source_code": str, "concept_id": np.int64, "value_int": np.int64, "quantity": np.float64}
    return align_to_types(found, types)


# ---- casts -------------------------------------------------------------------


def _number_texts(spark: SparkSession, sf: str) -> DataFrame:
    part, supp = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    odd = F.col("l_suppkey") % 4
    line = F.col("l_linenumber")
    x = (
        F.when(line == 1, part)
        .when(line == 2, F.concat(F.lit("  "), part, F.lit(" ")))
        .when(line == 3, F.concat(F.lit("-"), part, F.lit(".75")))
        .when(line == 4, F.concat(supp, F.lit("e3")))
        .when(
            line == 5,
            F.when(odd == 0, F.lit("inf"))
            .when(odd == 1, F.lit("NaN"))
            .when(odd == 2, F.concat(part, F.lit("d")))
            .otherwise(F.lit("")),
        )
        .when(
            line == 6,
            F.concat(F.lit("90071992547"), F.lpad((F.col("l_suppkey") % 100000).cast("string"), 5, "0")),
        )
    )
    return _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", x.alias("x"))


def _time_texts(spark: SparkSession, sf: str) -> DataFrame:
    lines = _table(spark, sf, "lineitem")
    shift = F.make_dt_interval(F.lit(0), (F.col("l_suppkey") % 24).cast("int"), F.col("l_linenumber").cast("int"))
    ts, k = F.col("ts"), F.col("l_partkey") % 21

    def fmt(pattern: str) -> Column:
        return F.date_format(ts, pattern)

    x = (
        F.when(k == 0, fmt("yyyyMMdd"))
        .when(k == 1, fmt("yyyyMMddHHmm"))
        .when(k == 2, fmt("yyyyMMddHHmmss"))
        .when(k == 3, F.concat(fmt("yyyyMMddHHmmss"), F.lit("-0500")))
        .when(k == 4, fmt("yyyy-MM-dd"))
        .when(k == 5, F.concat(fmt("yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(k == 6, fmt("MM/dd/yyyy"))
        .when(k == 7, fmt("yyyyMM"))
        .when(k == 8, fmt("yyyy"))
        .when(k == 9, fmt("yyyyMMddHH"))
        .when(k == 10, F.lit("abc"))
        .when(k == 11, F.lit("0000"))
        .when(k == 12, F.concat(fmt("yyyyMMddHHmm"), F.lit("+0200")))
        .when(k == 14, fmt("MMM dd yyyy"))
        .when(k == 15, fmt("dd-MMM-yyyy"))
        .when(k == 16, fmt("MM/dd/yy"))
        .when(k == 17, fmt("yyyy-MM-dd hh:mm a"))
        .when(k == 18, fmt("MM/dd/yyyy hh:mm:ss a"))
        .when(k == 19, fmt("yyyyMMdd'T'HHmmss"))
        .when(k == 20, F.concat(fmt("yyyyMMddHHmm"), F.lit("-05:00")))
    )
    stamped = lines.withColumn("ts", F.col("l_shipdate") + shift)
    return stamped.select("l_orderkey", "l_linenumber", "l_partkey", x.alias("x"))


@_query
def cast_int(spark: SparkSession, sf: str) -> DataFrame:
    x = F.col("x")
    return _number_texts(spark, sf).select(
        "*", casts.to_int(x).alias("as_int64"), casts.to_int(x, bits=32).alias("as_int32")
    )


@_query
def cast_float(spark: SparkSession, sf: str) -> DataFrame:
    x = F.col("x")
    single = casts.to_float(x, bits=32).cast("double")
    return _number_texts(spark, sf).select("*", casts.to_float(x).alias("as_float64"), single.alias("as_float32"))


@_query
def cast_date(spark: SparkSession, sf: str) -> DataFrame:
    return _time_texts(spark, sf).select("*", casts.to_date(F.col("x")).alias("as_date"))


@_query
def cast_ts(spark: SparkSession, sf: str) -> DataFrame:
    return _wall_clock(_time_texts(spark, sf).select("*", casts.to_timestamp(F.col("x")).alias("as_ts")))


@_query
def cast_str(spark: SparkSession, sf: str) -> DataFrame:
    lines = _table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_partkey",
        "l_shipdate",
        "l_returnflag",
        F.col("l_shipdate").cast("date").alias("day"),
        F.when(F.col("l_linenumber") == 5, F.lit(float("nan")))
        .otherwise(F.col("l_partkey") * 1e6 + 0.5)
        .alias("big"),
    )
    types = {f.name: f.dataType for f in lines.schema.fields}

    def text(name: str) -> Column:
        return casts.to_str(F.col(name), types[name])

    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_partkey",
        text("l_partkey").alias("int_text"),
        text("big").alias("float_text"),
        text("l_shipdate").alias("ts_text"),
        text("day").alias("date_text"),
        text("l_returnflag").alias("str_text"),
    )


@_query
def null_check(spark: SparkSession, sf: str) -> DataFrame:
    """Null and NaN are null; the text 'NaN' is not."""
    line = F.col("l_linenumber")
    value = F.when(line == 3, F.lit(float("nan"))).when(line != 5, F.col("l_quantity"))
    text = F.when(line != 4, F.lit(""))
    lines = _table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", value.alias("value"), F.lit("NaN").alias("nan_text"), text.alias("text")
    )
    checks = [
        casts.is_null(F.col(n), lines.schema[n].dataType).alias(f"{n}_is_null") for n in ("value", "nan_text", "text")
    ]
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", *checks)


@_query
def coerce_table(spark: SparkSession, sf: str) -> DataFrame:
    """A frame of text cast column by column to its declared types."""
    lines = _table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.concat(F.lit(" "), F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("l_shipdate"),
        F.round(F.col("l_discount") * 100).cast("int").cast("string").alias("untouched"),
    )
    types = {
        "l_orderkey": np.int64,
        "absent": np.int64,
        "l_linenumber": np.int32,
        "l_quantity": np.float64,
        "l_shipdate": datetime.date,
    }
    return casts.coerce_frame(lines, types)


@_query
def plus_one_udf(spark: SparkSession, sf: str) -> DataFrame:
    """A vectorised user function over every line."""
    lines = _table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", plus_one(F.col("l_partkey")).alias("part_plus_one"))


# ---- reports -----------------------------------------------------------------


@_query
def empty_tables_skipped(spark: SparkSession, sf: str) -> DataFrame:
    """Tables that get a file: those whose configs yielded rows."""
    counted = report.config_counts(_counted(spark, sf), C.CONFIGS)
    routed = route(counted, routes_frame(spark, C.CONFIGS, C.ROUTING))
    return routed.groupBy("table").agg(F.sum("n").alias("n")).where("n > 0")


@_query
def quarantine_(spark: SparkSession, sf: str) -> DataFrame:
    return quarantine(parse_documents(C.documents(spark, sf), [C.PATIENT]))


@_query
def document_status(spark: SparkSession, sf: str) -> DataFrame:
    """Every document to its log lines: one per table with rows, or its error."""
    return _status_lines(spark, sf)


@_query
def run_status(spark: SparkSession, sf: str) -> DataFrame:
    return report.status_counts(_status_lines(spark, sf))


@_query
def ok_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return report.ok_pairs(_status(spark, sf))


@_query
def error_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return report.error_histogram(_status_lines(spark, sf))


@_query
def table_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return report.table_counts(_counted(spark, sf), C.CONFIGS, C.ROUTING)


@_query
def shape_log(spark: SparkSession, sf: str) -> DataFrame:
    return report.shape_log(_counted(spark, sf), C.CONFIGS)


@_query
def preview(spark: SparkSession, sf: str) -> DataFrame:
    """The feature is the limit: the first hundred rows in a fixed order."""
    rows = _converted(spark, sf, "measurement")
    return _wall_clock(report.preview(rows, ["visit_id", "source_code", "seq", "value"], 100))


@_query
def column_probe(spark: SparkSession, sf: str) -> DataFrame:
    return report.column_probe(_converted(spark, sf, "visit"), "start_at", ["doc_id"])


# ---- sinks -------------------------------------------------------------------


@_query
def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A domain folder written, and read back under the declared schema."""
    base = scratch_path(spark, "domains")
    writers.write_domains({"Measurement": _converted(spark, sf, "measurement")}, base)
    schema = C.ROUTING.schema("measurement")
    read = tables.read_tables(spark, base, DOMAINS, {"Measurement": schema}, suffix="_parquet")
    return _wall_clock(read["Measurement"])


@_query
def compact_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Many small files rewritten as one table, the small ones dropped."""
    base = scratch_path(spark, "small")
    schemas = {"measurement": C.ROUTING.schema("measurement")}
    writers.write_table(_converted(spark, sf, "measurement"), f"{base}/measurement", max_rows_per_file=2_000)
    writers.compact_tables(spark, base, schemas)
    return _wall_clock(tables.read_tables(spark, base, schemas, schemas)["measurement"])


def _published(spark: SparkSession, sf: str) -> str:
    """Two versions: tables, then one of them replaced; a third publication fails on its way."""
    base = scratch_path(spark, "published")
    publish.publish({"measurement": _converted(spark, sf, "measurement", [C.VITALS]), "drug": _converted(spark, sf, "drug")}, base, "first")
    # Parsed once and stored: a frame used four times would parse every document four times.
    whole = _converted(spark, sf, "measurement").checkpoint()
    publish.publish({"measurement": whole}, base, "second")
    broken = whole.where(F.when(F.col("visit_id") % 1000 == 500, F.raise_error(F.lit("no more"))).otherwise(F.lit(True)))
    try:
        publish.publish({"drug": whole, "measurement": broken}, base, "third")
    except publish.PublishError:
        pass
    publish.publish({"measurement": whole.limit(0)}, base, "second")  # a rerun changes nothing
    return base


@_query
def publish_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table read through the manifest, after a replacement, a failed publication and a rerun."""
    return _wall_clock(publish.read_published(spark, _published(spark, sf), "measurement"))


@_query
def publish_history(spark: SparkSession, sf: str) -> DataFrame:
    """What every version holds, with rows counted while they were written."""
    return publish.history(spark, _published(spark, sf))


def _compacted(spark: SparkSession, sf: str) -> str:
    """A table published, two small pieces appended and compacted, two more appended and compacted."""
    base = scratch_path(spark, "parts")
    # Parsed once and stored: the whole and each piece would parse every document again.
    whole = _converted(spark, sf, "measurement").checkpoint()
    publish.publish({"measurement": whole.where("visit_id % 1000 > 3")}, base, "whole")
    for piece in range(4):
        publish.append({"measurement": whole.where(F.col("visit_id") % 1000 == piece)}, base, f"piece {piece}")
        if piece % 2:
            size = publish.manifest(spark, base).tables["measurement"].parts[0].size
            publish.compact_parts(spark, base, "measurement", target=size)
    return base


@_query
def compact_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The table after appends and compactions of the small parts only."""
    return _wall_clock(publish.read_published(spark, _compacted(spark, sf), "measurement"))


@_query
def compact_history(spark: SparkSession, sf: str) -> DataFrame:
    """Parts and rows of every version on the way."""
    return publish.history(spark, _compacted(spark, sf)).select("number", "table", "parts", "rows")


@_query
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "csv")
    table = _converted(spark, sf, "drug")
    writers.write_csv(table, f"{base}/drug.csv")
    return _wall_clock(spark.read.schema(table.schema).options(**writers.CSV_OPTIONS).csv(f"{base}/drug.csv"))


@_query
def csv_per_doc(spark: SparkSession, sf: str) -> DataFrame:
    """The CSV file of every document, looked-up column included: packed as rows, through the CSV sink."""
    parsed = parse_documents(C.documents(spark, sf), [C.RESULTS])
    packed = writers.document_csv(parsed, C.RESULTS, unique_codemap(C.codemap(spark, sf)))
    path = scratch_path(spark, "csv-per-document")
    writers.write_csv(packed, path)
    return spark.read.schema(packed.schema).options(**writers.CSV_OPTIONS, multiLine="true").csv(path)


@_query
def csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """The CSV files of all documents as files of their own, written by the tasks and read back."""
    parsed = parse_documents(C.documents(spark, sf), [C.RESULTS])
    path = scratch_path(spark, "csv-files")
    packed = writers.document_csv(parsed, C.RESULTS, unique_codemap(C.codemap(spark, sf)))
    write_files(packed, path, content="csv", folders=256)
    return sources.scan_files(spark, path).select("file_name", F.col("content").cast("string").alias("csv"))


@_query
def document_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """A table with its document column, partitioned by a hash of it for per-document reads."""
    path = scratch_path(spark, "by-document")
    drugs = _converted(spark, sf, "drug").withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(16)))
    writers.write_table(drugs, path, partition_by=["batch"])
    return spark.read.parquet(path).select("doc_id", "seq", "source_code", "concept_id", "quantity", "measured_on")


@_query
def output_files(spark: SparkSession, sf: str) -> DataFrame:
    """Number of data files of a run: one per order priority, and one per last digit of a person."""
    base = scratch_path(spark, "output")
    visits = _converted(spark, sf, "visit").repartition("priority")
    writers.write_table(visits, f"{base}/visit.parquet", partition_by=["priority"])
    people = _converted(spark, sf, "person").withColumn("digit", F.col("person_id") % 10).repartition("digit")
    writers.write_table(people, f"{base}/person.parquet", partition_by=["digit"])
    return writers.count_output_files(spark, base)


@_query
def convert_job(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job: parse once, write every table, read them back and count."""
    base = scratch_path(spark, "job")
    job = convert(C.documents(spark, sf), C.CONFIGS, C.ROUTING, C.codemap(spark, sf))
    failed = [r for r in job.write(base) if r.error]
    if failed:
        raise RuntimeError(f"tables not written: {failed}; the parsed documents are in {job.stage}")
    job.drop_stage()
    read = tables.read_tables(spark, base, job.table_names(), {t: C.ROUTING.schema(t) for t in job.table_names()})
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("doc_id").alias("n_documents")).select(
            F.lit(name).alias("table"), "n_rows", "n_documents"
        )
        for name, df in read.items()
    ]
    return union_all(counts)

