"""Vectors of the lenient casts."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart.functions import casts
from docmart.functions.names import doc_id
from docmart.functions.schema import spark_type, table_schema
from docmart.functions.udf import plus_one

UTC = dt.UTC


def run(spark, values, expression, schema="x string"):
    frame = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in frame.select(expression).collect()]


INTS = {
    "12": 12, " 12 ": 12, "\t12\n": 12, "3.7": 3, "-3.7": -3, "1e3": 1000, "+5": 5, ".5": 0, "5.": 5,
    "abc": None, "": None, "0x10": None, "1,000": None, None: None, "NaN": None, "inf": None, "12d": None,
    "9007199254740993": 9007199254740993, "99999999999999999999": None, "9223372036854775807": 2**63 - 1,
    "9223372036854775808": None, "-9223372036854775808": -(2**63), "1e400": None, "1e-30": 0, "1_000": None,
}

FLOATS = {
    "12": 12.0, " 12 ": 12.0, "3.7": 3.7, "-3.7": -3.7, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "abc": None, "": None,
    "0x10": None, "0x1p3": None, "1,000": None, None: None, "NaN": None, "nan": None, "inf": math.inf,
    "-Infinity": -math.inf, " INF ": math.inf, "9007199254740993": 9007199254740992.0,
    "99999999999999999999": 1e20, "12d": None, "12f": None, "1e400": math.inf,
}

D = dt.date(2012, 8, 15)
TIMES = {
    # text: (date, UTC timestamp)
    "20120815": (D, dt.datetime(2012, 8, 15)),
    " 20120815 ": (D, dt.datetime(2012, 8, 15)),
    "201208151030": (D, dt.datetime(2012, 8, 15, 10, 30)),
    "20120815103000": (D, dt.datetime(2012, 8, 15, 10, 30)),
    "20120815103000.125": (D, dt.datetime(2012, 8, 15, 10, 30, 0, 125000)),
    "20120815103000-0500": (D, dt.datetime(2012, 8, 15, 15, 30)),
    "20120815233000-0500": (D, dt.datetime(2012, 8, 16, 4, 30)),
    "20120815103000.125-0500": (D, dt.datetime(2012, 8, 15, 15, 30, 0, 125000)),
    "201208151030-0500": (D, dt.datetime(2012, 8, 15, 15, 30)),
    "20120815-0500": (D, dt.datetime(2012, 8, 15, 5)),
    "20120815103000Z": (D, dt.datetime(2012, 8, 15, 10, 30)),
    "2012-08-15": (D, dt.datetime(2012, 8, 15)),
    "08/15/2012": (D, dt.datetime(2012, 8, 15)),
    "8/5/2012": (dt.date(2012, 8, 5), dt.datetime(2012, 8, 5)),
    "08/15/2012 10:30": (D, dt.datetime(2012, 8, 15, 10, 30)),
    "2012/08/15": (D, dt.datetime(2012, 8, 15)),
    "2012-08-15T10:30:00Z": (D, dt.datetime(2012, 8, 15, 10, 30)),
    "2012-08-15T23:30:00-05:00": (D, dt.datetime(2012, 8, 16, 4, 30)),
    "2012-08-15 10:30": (D, dt.datetime(2012, 8, 15, 10, 30)),
    "2012": (dt.date(2012, 1, 1), dt.datetime(2012, 1, 1)),
    "2012-08": (dt.date(2012, 8, 1), dt.datetime(2012, 8, 1)),
    "201208": (dt.date(2012, 8, 1), dt.datetime(2012, 8, 1)),
    "1500-01-01": (dt.date(1500, 1, 1), dt.datetime(1500, 1, 1)),
    "3000-01-01": (dt.date(3000, 1, 1), dt.datetime(3000, 1, 1)),
}
NO_TIMES = [
    "15/08/2012", "2012081510", "20121340", "20120815256000", "2012-02-30", "abc", "", "0000", "00000101", None, "now",
    "12:30", "20120815103", "2012-08-15garbage", "123456-01-01", "0000-01-01", "1/1/0000",
]


def test_int_vectors(spark):
    assert run(spark, INTS, casts.to_int(F.col("x"))) == list(INTS.values())


def test_int32_overflow_is_null(spark):
    got = run(spark, ["2147483647", "2147483648", "-2147483649", "7.9"], casts.to_int(F.col("x"), bits=32))
    assert got == [2147483647, None, None, 7]


def test_int_from_other_types(spark):
    doubles = [3.9, -3.9, math.nan, math.inf, 9.3e18, None]
    assert run(spark, doubles, casts.to_int(F.col("x"), T.DoubleType()), "x double") == [3, -3, None, None, None, None]
    assert run(spark, [True, False, None], casts.to_int(F.col("x"), T.BooleanType()), "x boolean") == [1, 0, None]


def test_float_vectors(spark):
    assert run(spark, FLOATS, casts.to_float(F.col("x"))) == list(FLOATS.values())


def test_float_nan_is_null(spark):
    assert run(spark, [1.5, math.nan, math.inf], casts.to_float(F.col("x"), T.DoubleType()), "x double") == [1.5, None, math.inf]


def test_date_vectors(spark):
    assert run(spark, TIMES, casts.to_date(F.col("x"))) == [d for d, _ in TIMES.values()]
    assert run(spark, NO_TIMES, casts.to_date(F.col("x"))) == [None] * len(NO_TIMES)


def test_timestamp_vectors(spark):
    wall = casts.to_timestamp(F.col("x")).cast("timestamp_ntz")
    assert run(spark, TIMES, wall) == [t for _, t in TIMES.values()]
    assert run(spark, NO_TIMES, casts.to_timestamp(F.col("x"))) == [None] * len(NO_TIMES)


SPELLED = {
    "Aug 15 2012": (dt.date(2012, 8, 15), dt.datetime(2012, 8, 15)),
    "August 15, 2012": (dt.date(2012, 8, 15), dt.datetime(2012, 8, 15)),
    "15-AUG-2012": (dt.date(2012, 8, 15), dt.datetime(2012, 8, 15)),
    "08/15/12": (dt.date(2012, 8, 15), dt.datetime(2012, 8, 15)),
    "1/2/85": (dt.date(1985, 1, 2), dt.datetime(1985, 1, 2)),
    "2012-08-15 10:30 PM": (dt.date(2012, 8, 15), dt.datetime(2012, 8, 15, 22, 30)),
    "8/15/2012 3:04:05 pm": (dt.date(2012, 8, 15), dt.datetime(2012, 8, 15, 15, 4, 5)),
    "20120815T103000": (dt.date(2012, 8, 15), dt.datetime(2012, 8, 15, 10, 30)),
    "20120815T233000-0500": (dt.date(2012, 8, 15), dt.datetime(2012, 8, 16, 4, 30)),
    "201208151030-05:00": (dt.date(2012, 8, 15), dt.datetime(2012, 8, 15, 15, 30)),
    "15.08.2012": (None, None),
    "Aug 45 2012": (None, None),
    "13/45/12": (None, None),
}


def test_further_spellings(spark):
    assert run(spark, SPELLED, casts.to_date(F.col("x"))) == [d for d, _ in SPELLED.values()]
    assert run(spark, SPELLED, casts.to_timestamp(F.col("x")).cast("timestamp_ntz")) == [t for _, t in SPELLED.values()]
    assert run(spark, ["٣"], casts.to_int(F.col("x"))) == run(spark, ["٣"], casts.to_float(F.col("x"))) == [None]


def test_local_date_does_not_depend_on_the_session_zone(spark):
    try:
        for zone in ("America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert run(spark, TIMES, casts.to_date(F.col("x"))) == [d for d, _ in TIMES.values()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_further_formats(spark):
    x = F.col("x")
    assert run(spark, ["15/08/2012", "20120815", "x"], casts.to_date(x, formats=["dd/MM/yyyy"])) == [D, D, None]
    wall = casts.to_timestamp(x, formats=["dd.MM.yyyy HH:mm"]).cast("timestamp_ntz")
    assert run(spark, ["15.08.2012 10:30"], wall) == [dt.datetime(2012, 8, 15, 10, 30)]


def test_dates_from_other_types(spark):
    assert run(spark, [20120815], casts.to_date(F.col("x"), T.LongType()), "x bigint") == [D]
    midnight = casts.to_timestamp(F.col("x"), T.DateType()).cast("timestamp_ntz")
    assert run(spark, [D], midnight, "x date") == [dt.datetime(2012, 8, 15)]
    late = dt.datetime(2012, 8, 15, 23, 59)
    assert run(spark, [late], casts.to_date(F.col("x"), T.TimestampNTZType()), "x timestamp_ntz") == [D]


def test_text_is_spelled_as_python_does(spark):
    doubles = [0.0, 1.0, -2.5, 1e7, 1.25e10, 123456789.125, 9.99e15, 1e16, 1.5e300, 1e-3, 2.5e-4, 1e-5, 3.25e-7, math.inf, -math.inf]
    got = run(spark, [*doubles, math.nan, None], casts.to_str(F.col("x"), T.DoubleType()), "x double")
    assert got == [*map(str, doubles), None, None]
    assert run(spark, [True, False, None], casts.to_str(F.col("x"), T.BooleanType()), "x boolean") == ["True", "False", None]
    stamps = [dt.datetime(2012, 8, 15, 1, 2, 3), dt.datetime(2012, 8, 15, 1, 2, 3, 120000), None]
    got = run(spark, stamps, casts.to_str(F.col("x"), T.TimestampNTZType()), "x timestamp_ntz")
    assert got == ["2012-08-15 01:02:03", "2012-08-15 01:02:03.120000", None]
    assert run(spark, ["", " a ", None], casts.to_str(F.col("x"))) == ["", " a ", None]


def test_null_test(spark):
    assert run(spark, [1.0, math.nan, None], casts.is_null(F.col("x"), T.DoubleType()), "x double") == [False, True, True]
    assert run(spark, ["NaN", "", None], casts.is_null(F.col("x"), T.StringType())) == [False, False, True]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=30))
def test_no_text_fails_a_row(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "x string")
    x = F.col("x")
    out = frame.select(casts.to_int(x), casts.to_float(x), casts.to_date(x), casts.to_timestamp(x).cast("string")).collect()
    assert len(out) == len(texts)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.integers(-(2**62), 2**62), st.floats(-1e6, 1e6, width=32)), min_size=1, max_size=30))
def test_numbers_agree_with_pandas(spark, numbers):
    texts = [str(n) for n in numbers]
    expected = [int(v) for v in (pd.to_numeric(t) for t in texts)]
    assert run(spark, texts, casts.to_int(F.col("x"))) == expected


# Spellings that pandas reads as well, and to the same value.
SHARED_FORMATS = [
    "%Y%m%d", "%Y%m%d%H%M", "%Y%m%d%H%M%S", "%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S%z", "%Y%m%d%H%M%S%z",
    "%Y%m%d%H%M%z", "%m/%d/%Y", "%m/%d/%Y %H:%M", "%Y/%m/%d", "%Y-%m", "%Y",
]


@settings(max_examples=25, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.datetimes(dt.datetime(1700, 1, 1), dt.datetime(2250, 1, 1)),
            st.sampled_from(SHARED_FORMATS),
            st.integers(-12, 14),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_times_agree_with_pandas(spark, drawn):
    texts = [t.replace(tzinfo=dt.timezone(dt.timedelta(hours=h))).strftime(f) for t, f, h in drawn]
    stamps = [pd.to_datetime(t) for t in texts]
    assert run(spark, texts, casts.to_date(F.col("x"))) == [s.date() for s in stamps]
    instants = [(s.tz_convert("UTC").tz_localize(None) if s.tzinfo else s).to_pydatetime() for s in stamps]
    assert run(spark, texts, casts.to_timestamp(F.col("x")).cast("timestamp_ntz")) == instants


@pytest.mark.parametrize(
    ("declared", "expected"),
    [
        (np.int64, T.LongType()), (np.int32, T.IntegerType()), (np.float64, T.DoubleType()), (np.float32, T.FloatType()),
        (dt.datetime, T.TimestampType()), (dt.date, T.DateType()), (str, T.StringType()), (np.dtype("int64"), T.LongType()),
        ("int32", T.IntegerType()), ("date", T.DateType()), (list, T.StringType()), ("blob", T.StringType()), (None, T.StringType()),
    ],
)
def test_declared_types(declared, expected):
    assert spark_type(declared) == expected


def test_schema_keeps_order_and_is_nullable():
    schema = table_schema({"b": np.int64, "a": str})
    assert [f.name for f in schema.fields] == ["b", "a"]
    assert all(f.nullable for f in schema.fields)


def test_coerce_frame(spark):
    frame = spark.createDataFrame([("7", "x", "2012"), ("bad", "y", None)], "a string, keep string, d string")
    out = casts.coerce_frame(frame, {"a": np.int32, "absent": np.int64, "d": dt.date, "keep": list})
    assert out.dtypes == [("a", "int"), ("keep", "string"), ("d", "date")]
    assert [tuple(r) for r in out.collect()] == [(7, "x", dt.date(2012, 1, 1)), (None, "y", None)]
    assert frame.dtypes[0] == ("a", "string")


def test_document_names(spark):
    names = {"a.xml": "a", "a.b.xml": "a.b", ".xml": ".xml", "noext": "noext", "a..xml": "a.", "..a": "..a", ".a.xml": ".a", "": ""}
    assert run(spark, names, doc_id(F.col("x"))) == list(names.values())


def test_vectorised_function(spark):
    assert run(spark, [1, 2, 4], plus_one(F.col("x")), "x bigint") == [2, 3, 5]
