"""A clinical corpus derived from the ``orders`` table, and its declarations.

One document per order, built row by row: no grouping, so no order, customer or
code can gather more than its own row. The number of records, their codes,
values and time formats follow from the keys by fixed rules:

======== ==================================================================
rule     meaning
======== ==================================================================
results  ``o_orderkey % 4`` records, code ``o_custkey + 7 i``
vitals   ``o_custkey % 3`` records, code ``o_custkey + 11 i``
medic.   ``(o_orderkey + o_custkey) % 3`` records, code ``o_custkey + 13 i``
notes    one if ``o_orderkey % 5 = 0``
system   ``LOCAL`` for ``i = 3``, else ``PART``
value    ``(o_orderkey + i) % 6``: clean, padded, fraction, junk, absent, exponent
time     ``(o_orderkey + i) % 7``: six spellings and junk
encounter absent if ``o_orderkey % 11 = 0``
document by ``o_orderkey % 97``: cut short if 0, empty 1, more after the root 2, a bare
         ampersand 3, an end tag without a start 4, an unknown entity 5, an
         attribute given twice 6, no XML 7; intact from 8 on
repeated a second ``id``, of which the first counts, if ``o_orderkey % 13 = 0``
======== ==================================================================
"""

from __future__ import annotations

import datetime
from xml.etree import ElementTree

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.functions.udf import isolated
from docmart.operators.rules import rule_config
from docmart.plans.config import (
    DomainConfig,
    Routing,
    Step,
    code_lookup,
    document_id,
    from_document,
    from_path,
    from_step,
)
from docmart.sources.corpus import spread
from docmart.sources.files import write_files

ROOT = "ClinicalDocument"
FAULTS = 8
BATCH = "ClinicalDocuments"


def _record_fields(value_column: str) -> tuple:
    return (
        document_id(),
        from_document("person_id", "patient._extension"),
        from_document("visit_id", "id._extension"),
        from_path("seq", "_seq"),
        from_path("source_code", "code._code"),
        code_lookup("concept_id", "code._codeSystem", "code._code", default=0),
        from_path(value_column, "value._value"),
        from_path("unit", "value._unit"),
        from_path("measured_at", "effectiveTime._value"),
        from_path("measured_on", "effectiveTime._value"),
    )


_MEASUREMENT_FIELDS = (*_record_fields("value"), from_path("value_int", "value._value"))

RESULTS = DomainConfig("results", _MEASUREMENT_FIELDS, (Step("results"),))
VITALS = DomainConfig("vitals", _MEASUREMENT_FIELDS, (Step("vitals"),))
MEDICATIONS = DomainConfig("medications", _record_fields("quantity"), (Step("medications"),))
ENCOUNTER = DomainConfig(
    "encounter",
    (
        document_id(),
        from_document("visit_id", "id._extension"),
        from_document("person_id", "patient._extension"),
        from_path("priority", "_priority"),
        from_path("start_at", "effectiveTime._value"),
        from_path("start_on", "effectiveTime._value"),
    ),
    (Step("encounter", many=False),),
)
PATIENT = DomainConfig("patient", (document_id(), from_document("person_id", "patient._extension")))
NOTES = DomainConfig("notes", (document_id(), from_path("text", "_text")), (Step("notes"),))
DEVICES = DomainConfig("devices", (document_id(), from_path("source_code", "code._code")), (Step("devices"),))

CONFIGS = (RESULTS, VITALS, MEDICATIONS, ENCOUNTER, PATIENT, NOTES, DEVICES)

_RECORD_TYPES = {
    "doc_id": str,
    "person_id": np.int64,
    "visit_id": np.int64,
    "seq": np.int32,
    "source_code": str,
    "concept_id": np.int64,
}
_TIME_TYPES = {"unit": str, "measured_at": datetime.datetime, "measured_on": datetime.date}

ROUTING = Routing(
    domain_of={
        "results": "Measurement",
        "vitals": "Measurement",
        "medications": "Drug",
        "encounter": "Visit",
        "patient": "Person",
        "devices": "Device",
    },
    table_of={
        "Measurement": "measurement",
        "Drug": "drug",
        "Visit": "visit",
        "Person": "person",
        "Device": "device",
    },
    types_of={
        "measurement": _RECORD_TYPES | {"value": np.float64, "value_int": np.int64} | _TIME_TYPES,
        "drug": _RECORD_TYPES | {"quantity": np.float64} | _TIME_TYPES,
        "visit": {
            "doc_id": str,
            "visit_id": np.int64,
            "person_id": np.int64,
            "priority": str,
            "start_at": datetime.datetime,
            "start_on": datetime.date,
            # Declared but filled by no config: a typed null in every row.
            "admitting_source_concept_id": np.int64,
        },
        "person": {"doc_id": str, "person_id": np.int64},
        "device": {"doc_id": str, "source_code": str},
    },
)

# The same records inside files that hold many documents each: two hops, with
# the document's own values taken from the outer one.
BATCH_VITALS = DomainConfig(
    "vitals",
    (
        from_step("doc_id", 0, "id._extension"),
        from_step("person_id", 0, "patient._extension"),
        from_step("visit_id", 0, "id._extension"),
        *_MEASUREMENT_FIELDS[3:],
    ),
    (Step(ROOT), Step("vitals")),
)


def _text(c: Column) -> Column:
    return c.cast("string")


def _value(i: Column) -> Column:
    base = _text(F.col("o_custkey") + i)
    rule = (F.col("o_orderkey") + i) % 6
    return (
        F.when(rule == 0, base)
        .when(rule == 1, F.concat(F.lit(" "), base, F.lit(" ")))
        .when(rule == 2, F.concat(base, F.lit(".7")))
        .when(rule == 3, F.lit("abc"))
        .when(rule == 5, F.concat(F.lit("-"), base, F.lit("e1")))
    )


def _time(i: Column) -> Column:
    ts = F.col("day") + F.make_dt_interval(i, i + 9, F.lit(30))
    rule = (F.col("o_orderkey") + i) % 7
    return (
        F.when(rule == 0, F.date_format(ts, "yyyyMMdd"))
        .when(rule == 1, F.date_format(ts, "yyyyMMddHHmmss"))
        .when(rule == 2, F.concat(F.date_format(ts, "yyyyMMddHHmmss"), F.lit("-0500")))
        .when(rule == 3, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(rule == 4, F.date_format(ts, "MM/dd/yyyy"))
        .when(rule == 5, F.lit("unknown"))
        .otherwise(F.date_format(ts, "yyyyMMddHHmm"))
    )


# Section, number of records, step of the code.
def _sections() -> list[tuple[str, Column, int]]:
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    return [("results", order % 4, 7), ("vitals", customer % 3, 11), ("medications", (order + customer) % 3, 13)]


def _numbers(count: Column) -> Column:
    return F.filter(F.sequence(F.lit(1), F.lit(3)), lambda i: i <= count)


def _code(i: Column, step: int) -> Column:
    return _text(F.col("o_custkey") + i * step)


def _system(i: Column) -> Column:
    return F.when(i == 3, F.lit("LOCAL")).otherwise(F.lit("PART"))


def _has_encounter() -> Column:
    return F.col("o_orderkey") % 11 != 0


def _has_note() -> Column:
    return F.col("o_orderkey") % 5 == 0


def _start() -> Column:
    return F.date_format("o_orderdate", "yyyyMMddHHmmss")


def _document_columns() -> dict[str, Column]:
    """The document as columns, for the XML file writer."""

    def section(count: Column, step: int) -> Column:
        def record(i: Column) -> Column:
            return F.struct(
                _text(i).alias("_seq"),
                F.struct(_code(i, step).alias("_code"), _system(i).alias("_codeSystem")).alias("code"),
                F.struct(_value(i).alias("_value"), F.lit("u").alias("_unit")).alias("value"),
                F.struct(_time(i).alias("_value")).alias("effectiveTime"),
            )

        return F.transform(_numbers(count), record)

    encounter = F.struct(
        F.col("o_orderpriority").alias("_priority"), F.struct(_start().alias("_value")).alias("effectiveTime")
    )
    return {
        "id": F.struct(_text(F.col("o_orderkey")).alias("_extension")),
        "patient": F.struct(_text(F.col("o_custkey")).alias("_extension")),
        "encounter": F.when(_has_encounter(), encounter),
        **{name: section(count, step) for name, count, step in _sections()},
        "notes": F.when(_has_note(), F.array(F.struct(F.col("o_orderstatus").alias("_text")))),
    }


def _document_text() -> Column:
    """The same document as text, by plain concatenation.

    ``to_xml`` gives the same but takes longer than parsing the text again, and
    would outweigh in every timing what is to be timed.
    """

    def attribute(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f' {name}="'), value, F.lit('"')), F.lit(""))

    def escaped(value: Column) -> Column:
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
            value = F.replace(value, F.lit(char), F.lit(entity))
        return value

    def section(name: str, count: Column, step: int) -> Column:
        def record(i: Column) -> Column:
            return F.concat(
                F.lit(f"<{name}"),
                attribute("seq", _text(i)),
                F.lit("><code"),
                attribute("code", _code(i, step)),
                attribute("codeSystem", _system(i)),
                F.lit("/><value"),
                attribute("value", _value(i)),
                F.lit(' unit="u"/><effectiveTime'),
                attribute("value", _time(i)),
                F.lit(f"/></{name}>"),
            )

        return F.array_join(F.transform(_numbers(count), record), "")

    encounter = F.concat(
        F.lit("<encounter"),
        attribute("priority", escaped(F.col("o_orderpriority"))),
        F.lit("><effectiveTime"),
        attribute("value", _start()),
        F.lit("/></encounter>"),
    )
    note = F.concat(F.lit("<notes"), attribute("text", escaped(F.col("o_orderstatus"))), F.lit("/>"))
    return F.concat(
        F.lit(f"<{ROOT}><id"),
        attribute("extension", _text(F.col("o_orderkey"))),
        F.lit("/><patient"),
        attribute("extension", _text(F.col("o_custkey"))),
        F.lit("/>"),
        F.when(_has_encounter(), encounter).otherwise(F.lit("")),
        *[section(*s) for s in _sections()],
        F.when(_has_note(), note).otherwise(F.lit("")),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit('<id extension="-1"/>')).otherwise(F.lit("")),
        F.lit(f"</{ROOT}>"),
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    # Orders are compact and documents are not: spread the rows before the text is made.
    return spread(orders, "o_orderkey").withColumn("day", F.date_trunc("day", "o_orderdate"))


def documents(spark: SparkSession, sf_dir: str, faults: int = FAULTS) -> DataFrame:
    """The corpus ``file_name, xml``, broken and empty documents included; of the kinds of faults
    the first ``faults`` only, the documents of the others being intact."""
    xml = _document_text()
    fault = F.when(F.col("o_orderkey") % 97 < faults, F.col("o_orderkey") % 97)
    end = f"</{ROOT}>"

    def before_end(more: str) -> Column:
        return F.replace(xml, F.lit(end), F.lit(more + end))

    damaged = (
        F.when(fault == 0, F.substring(xml, 1, 40))
        .when(fault == 1, F.lit(""))
        .when(fault == 2, F.concat(xml, F.lit("<more/>")))
        .when(fault == 3, before_end("&"))
        .when(fault == 4, before_end("</patient>"))
        .when(fault == 5, before_end("&unknown;"))
        .when(fault == 6, before_end('<twice a="1" a="2"/>'))
        .when(fault == 7, F.lit("no XML"))
        .otherwise(xml)
    )
    name = F.concat(_text(F.col("o_orderkey")), F.lit(".xml"))
    return _orders(spark, sf_dir).select(name.alias("file_name"), damaged.alias("xml"))


def write_batches(spark: SparkSession, sf_dir: str, path: str, per_file: int = 500) -> None:
    """All documents as XML files: the intact ones of ``per_file`` neighbouring keys in one file, each
    faulty one as a file of its own, so that a fault spoils nothing else."""
    docs = documents(spark, sf_dir).withColumn("key", F.regexp_replace("file_name", r"\.xml$", "").cast("long"))
    faulty = docs.where(F.col("key") % 97 < FAULTS).select("file_name", F.col("xml").alias("content"))
    ordered = F.array_sort(F.collect_list(F.struct("key", "xml")))["xml"]
    batch = F.concat(F.lit(f"<{BATCH}>"), F.array_join(ordered, "\n"), F.lit(f"</{BATCH}>"))
    # A batch holds at most ``per_file`` keys, so a group is bounded.
    batches = docs.where(F.col("key") % 97 >= FAULTS).groupBy(F.floor(F.col("key") / per_file).alias("n")).agg(batch.alias("content"))
    named = batches.select(F.format_string("batch-%d.xml", "n").alias("file_name"), "content")
    write_files(faulty.union(named), path)


def write_text(spark: SparkSession, sf_dir: str, path: str, per_file: int = 20_000) -> None:
    """All documents, the faulty ones as well, in text files of many documents each."""
    texts = documents(spark, sf_dir).select(F.col("xml").alias("value"))
    texts.write.option("maxRecordsPerFile", per_file).text(path)


def codemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts of part keys; every tenth is missing on purpose."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").where(F.col("p_partkey") % 10 != 0)
    return part.select(
        F.lit("PART").alias("code_system"),
        _text(F.col("p_partkey")).alias("code"),
        (F.col("p_partkey") + 1_000_000).alias("concept_id"),
    )


RULE_CONFIGS = tuple(
    rule_config(name, ["doc_id", "person_id", "visit_id", "seq", "source_code", "value", "unit", "measured_at"])
    for name in ("results", "vitals")
)


def python_rule(file_name: str, xml: str) -> dict[str, list[dict]]:
    """Results and vitals by a plain Python function. It refuses documents of some visits, and those
    that are no XML."""
    root = ElementTree.fromstring(xml)
    visit = root.find("id").get("extension")
    if int(visit) % 89 == 3:
        raise ValueError(f"visit {visit} is closed")
    person = root.find("patient").get("extension")
    found: dict[str, list[dict]] = {}
    for name in ("results", "vitals"):
        found[name] = [
            {
                "doc_id": file_name.removesuffix(".xml"),
                "person_id": person,
                "visit_id": int(visit),
                "seq": r.get("seq"),
                "source_code": r.find("code").get("code"),
                "value": r.find("value").get("value"),
                "unit": r.find("value").get("unit"),
                "measured_at": r.find("effectiveTime").get("value"),
            }
            for r in root.findall(name)
        ]
    return found


@isolated("long")
def odd_reciprocal(keys: pd.Series) -> pd.Series:
    """A thousand by the last digit of a key; raises where that is zero."""
    plain = keys.to_numpy()  # a call may hold a single key, for which pandas takes long
    last = plain % 10
    zero = last == 0
    if zero.any():
        raise ZeroDivisionError(f"key {plain[zero.argmax()]}")
    return pd.Series(1000 // last)
