"""User functions in Python: one fate per document, one per value."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from docmart.functions.udf import isolated
from docmart.operators.diagnose import cause_of, causes, diagnose
from docmart.operators.parse import quarantine
from docmart.operators.report import status_line
from docmart.operators.rules import rule_config, rule_records, run_rule
from docmart.plans.config import Routing
from docmart.plans.pipeline import convert_by_rule

CONFIGS = [rule_config("a", ["doc_id", "n", "at"]), rule_config("b", ["n", "other"])]
ROUTING = Routing(
    domain_of={"a": "A", "b": "B"},
    table_of={"A": "ta", "B": "tb"},
    types_of={"ta": {"doc_id": str, "n": np.int64, "at": dt.datetime}, "tb": {"doc_id": str, "n": np.float64, "other": str, "absent": str}},
)


def make_rule():
    """A nested function travels to the workers by value; they cannot import this module."""

    def rule(name, xml):
        if xml == "raise":
            raise ValueError(f"no {name}")
        if xml == "exit":
            raise KeyError("k")
        shapes = {
            "none": None,
            "list": [1],
            "unknown": {"c": []},
            "record": {"a": ["text"]},
            "lazy": {"a": ({"n": 1 // (1 - i)} for i in range(3))},
            "nothing": {"a": [], "b": None},
            "frame": {"b": pd.DataFrame({"n": [1.5, float("nan")], "other": ["x", None], "extra": [1, 2]})},
        }
        if xml in shapes:
            return shapes[xml]
        return {"a": [{"doc_id": name, "n": len(xml), "at": dt.datetime(2020, 1, 2, 3, 4, 5)}, {"doc_id": name, "n": "junk"}], "b": [{"n": 2}]}

    return rule


rule = make_rule()


def corpus(spark, texts):
    return spark.createDataFrame([(f"{i}.xml", t) for i, t in enumerate(texts)], "file_name string, xml string")


def test_every_document_has_its_own_fate(spark):
    texts = ["ok", "raise", "none", "list", "unknown", "record", "lazy", "nothing", "frame", None, "exit", ""]
    done = run_rule(corpus(spark, texts).coalesce(1), rule, CONFIGS)
    got = {r["file_name"]: r for r in done.collect()}
    assert {n: r["error"] for n, r in got.items() if r["error"]} == {
        "1.xml": "ValueError: no 1.xml",
        "3.xml": "TypeError: the rule gave a list, not a mapping of configs",
        "4.xml": "KeyError: 'not declared: c'",
        "5.xml": "TypeError: a record is a str, not a mapping",
        "6.xml": "ZeroDivisionError: integer division or modulo by zero",
        "9.xml": "unreadable document",
        "10.xml": "KeyError: 'k'",
    }
    assert {n: r["xml"] for n, r in got.items() if r["xml"]} == {f"{i}.xml": texts[i] for i in (1, 3, 4, 5, 6, 10)}
    assert {n: tuple(r["counts"]) for n, r in got.items()}["0.xml"] == (2, 1)
    assert tuple(got["7.xml"]["counts"]) == (None, None)
    rows = sorted(((r["doc_id"], r["config"], r["n"], r["other"]) for r in rule_records(done, CONFIGS).where("config = 'b'").collect()), key=str)
    assert rows == sorted([("0", "b", "2", None), ("11", "b", "2", None), ("8", "b", "1.5", "x"), ("8", "b", None, None)], key=str)


def test_tables_quarantine_and_status(spark):
    texts = ["ok", "raise", "frame", "abcd"]
    job = convert_by_rule(corpus(spark, texts), rule, CONFIGS, ROUTING)
    a = sorted(map(tuple, job.table("ta").select("doc_id", "n", F.col("at").cast("string")).collect()), key=str)
    assert a == sorted([("0.xml", 2, "2020-01-02 03:04:05"), ("0.xml", None, None), ("3.xml", 4, "2020-01-02 03:04:05"), ("3.xml", None, None)], key=str)
    assert sorted(r["n"] or -1 for r in job.table("tb").collect()) == [-1, 1.5, 2, 2]
    assert [(r["doc_id"], r["message"], r["xml"]) for r in job.quarantine().collect()] == [("1", "ValueError: no 1.xml", "raise")]
    lines = sorted(r["line"] for r in job.status().select(status_line().alias("line")).collect())
    assert lines == ["ERROR: 1.xml :: ValueError: no 1.xml", "OK: 0 -> ta", "OK: 0 -> tb", "OK: 2 -> tb", "OK: 3 -> ta", "OK: 3 -> tb"]
    assert {r["table"]: r["n"] for r in job.table_counts().collect()} == {"ta": 4, "tb": 4}
    with pytest.raises(ValueError, match="looks its codes up"):
        job.codemap  # noqa: B018
    job.drop_stage()


def test_three_of_fifteen_thousand(spark):
    ids = spark.range(15_000).select(F.concat("id", F.lit(".xml")).alias("file_name"), F.when(F.col("id") % 5000 == 17, F.lit("raise")).otherwise(F.lit("ok")).alias("xml"))
    done = run_rule(ids, rule, CONFIGS)
    fates = done.groupBy(F.col("error").isNull().alias("good")).count().collect()
    assert {r["good"]: r["count"] for r in fates} == {True: 14_997, False: 3}
    assert {r["message"] for r in quarantine(done).collect()} == {f"ValueError: no {i}.xml" for i in (17, 5017, 10_017)}


def test_rule_over_nothing(spark):
    assert run_rule(corpus(spark, []), rule, CONFIGS).count() == 0


def test_isolated_values(spark):
    @isolated("int")
    def shaky(values):
        if (values == 3).any():
            raise ValueError("three")
        if (values == 4).any():
            return values[:0]
        return pd.Series([2**40 if v == 5 else v + 1 for v in values])

    got = spark.range(8).coalesce(1).select("id", shaky(F.col("id")).alias("r")).select("id", "r.*").collect()
    assert {r["id"]: r["value"] for r in got} == {0: 1, 1: 2, 2: 3, 3: None, 4: None, 5: None, 6: 7, 7: 8}
    errors = {r["id"]: r["error"] for r in got if r["error"]}
    assert errors[3] == "ValueError: three" and errors[4] == "ValueError: 0 results for 1 values" and "ArrowInvalid" in errors[5]
    assert set(errors) == {3, 4, 5}
    assert spark.range(0).select(shaky(F.col("id")).alias("r")).count() == 0


def test_isolated_halves_a_batch_that_raises(spark):
    calls = spark.sparkContext.accumulator(0)

    @isolated("long")
    def reciprocal(values):
        calls.add(1)
        if (values % 1000 == 7).any():
            raise ZeroDivisionError(f"key {values[values % 1000 == 7].iloc[0]}")
        return values * 2

    got = spark.range(4000).coalesce(1).select("id", reciprocal(F.col("id")).alias("r")).select("id", "r.*").collect()
    assert {r["id"]: r["value"] for r in got} == {i: None if i % 1000 == 7 else 2 * i for i in range(4000)}
    assert {r["id"]: r["error"] for r in got if r["error"]} == {i: f"ZeroDivisionError: key {i}" for i in (7, 1007, 2007, 3007)}
    # Four raising values among 4000: tens of calls, not one per value.
    assert calls.value < 200


def test_isolated_where_many_values_raise(spark):
    """One value in ten raises, at odd places: few calls besides those of the raising values."""
    calls = spark.sparkContext.accumulator(0)

    @isolated("long")
    def shaky(values):
        calls.add(1)
        bad = values[values * 7919 % 1009 < 101]
        if len(bad):
            raise ValueError(f"key {bad.iloc[0]}")
        return values * 2

    got = spark.range(4000).coalesce(1).select("id", shaky(F.col("id")).alias("r")).select("id", "r.*").collect()
    raising = {i for i in range(4000) if i * 7919 % 1009 < 101}
    assert {r["id"]: r["value"] for r in got} == {i: None if i in raising else 2 * i for i in range(4000)}
    assert {r["id"]: r["error"] for r in got if r["error"]} == {i: f"ValueError: key {i}" for i in raising}
    # Halves of halves took 0.7 calls a value.
    assert len(raising) <= calls.value < 0.6 * 4000


def test_isolated_where_only_the_size_raises(spark):
    @isolated("double")
    def short(values):
        if len(values) > 5:
            raise ValueError("too long")
        return values / 2

    got = spark.range(100).coalesce(1).select("id", short(F.when(F.col("id") % 9 > 0, F.col("id"))).alias("r")).select("id", "r.*").collect()
    assert {r["id"]: (r["value"], r["error"]) for r in got} == {i: (i / 2 if i % 9 else None, None) for i in range(100)}


def test_odd_reciprocal(spark):
    from docmart.plans.clinical import odd_reciprocal

    frame = spark.createDataFrame([(k,) for k in (20, 7, -3, 0, 11, 1_200_000, -10)], "k long").coalesce(1)
    got = {r["k"]: (r["value"], r["error"]) for r in frame.select("k", odd_reciprocal(F.col("k")).alias("r")).select("k", "r.*").collect()}
    raised = {k: (None, f"ZeroDivisionError: key {k}") for k in (20, 0, 1_200_000, -10)}
    assert got == raised | {7: (142, None), -3: (1000 // 7, None), 11: (1000, None)}
    nulls = spark.createDataFrame([(k,) for k in (7, None, 11)], "k long").coalesce(1).select("k", odd_reciprocal(F.col("k")).alias("r")).select("k", "r.*")
    assert {tuple(r) for r in nulls.collect()} == {(7, 142, None), (None, None, None), (11, 1000, None)}


def test_causes(spark):
    texts = ["<a>", "<a", "", None, "<a/><b/>", "<a>&x;</a>", "<a>\n<b></a>", "x", "<a/>"]
    rows = [(f"{i}", f"{i}", "m", t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id string, file_name string, message string, xml string")
    got = {int(r["file_name"]): (r["cause"], r["line"], r["column"]) for r in diagnose(frame).collect()}
    assert got == {i: cause_of(t) for i, t in enumerate(texts)}
    assert got[6] == ("mismatched tag", 2, 6) and got[3] == ("unreadable", None, None) and got[8] == (None, None, None)
    hist = [tuple(r) for r in causes(diagnose(frame)).collect()]
    assert hist[0] == ("no element found", 2) and ("m", 1) in hist and sum(n for _, n in hist) == len(texts)
    assert diagnose(frame.limit(0)).count() == 0
