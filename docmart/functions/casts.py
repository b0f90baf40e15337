"""Lenient casts as Column expressions.

Every function turns a value that cannot be read into null and never fails a
row, also under ANSI mode. They are built-in expressions only, so they stay in
the JVM and inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart.functions.schema import is_known_type, spark_type

# A cast alone would also read Java literals such as '12d' and '0x1p3', and 'NaN'.
_REAL = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"

# Spellings of points in time. Text of digits only must be told apart by its
# length: a plain cast reads '201208' as the year 201208. A bare clock time, which
# a plain cast puts on today, is none of them.
_DIGITS = r"^(?!0000)(\d{4}|\d{6}|\d{8}|\d{12}|\d{14})$"
_DIGITS_AND_ZONE = r"^(?!0000)(\d{8}|\d{12}|\d{14}|\d{14}\.\d{1,6})([+-]\d{4}|Z)?$"
_SEPARATED = r"^((?!0000)\d{4}[-/]|\d{1,2}/\d{1,2}/(?!0000)\d{4}( |$))"
_MONTH_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})"
_YEAR_FIRST = r"^(\d{4})/(\d{1,2})/(\d{1,2})"
_FULL_DIGITS = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})"
_FULL_ISO = "$1-$2-$3T$4:$5:$6"
# What to append to 4, 6, 8 or 12 digits: first month, first day, midnight.
_FILL = "00000101000000"


# Further spellings, looked at only where the above give nothing: what the text, with commas taken
# as spaces, looks like, and its pattern. Day-first numbers such as 15.08.2012 are no part of them.
_CLOCK = r"\d{1,2}:\d{2}"
_SPELLED = (
    (r"^[A-Za-z]{3} \d{1,2} \d{4}$", "MMM d yyyy"),
    (r"^[A-Za-z]{4,} \d{1,2} \d{4}$", "MMMM d yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (rf"^\d{{4}}-\d{{2}}-\d{{2}} {_CLOCK} [AaPp][Mm]$", "yyyy-MM-dd h:mm a"),
    (rf"^\d{{4}}-\d{{2}}-\d{{2}} {_CLOCK}:\d{{2}} [AaPp][Mm]$", "yyyy-MM-dd h:mm:ss a"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}} {_CLOCK} [AaPp][Mm]$", "M/d/yyyy h:mm a"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}} {_CLOCK}:\d{{2}} [AaPp][Mm]$", "M/d/yyyy h:mm:ss a"),
    (r"^\d{8}T\d{4}$", "yyyyMMdd'T'HHmm"),
    (r"^\d{8}T\d{6}$", "yyyyMMdd'T'HHmmss"),
    (r"^\d{8}T\d{6}[+-]\d{4}$", "yyyyMMdd'T'HHmmssxx"),
    (r"^\d{12}[+-]\d{2}:\d{2}$", "yyyyMMddHHmmxxx"),
    (r"^\d{14}[+-]\d{2}:\d{2}$", "yyyyMMddHHmmssxxx"),
)


def is_null(c: Column, source: T.DataType | None = None) -> Column:
    """True for null and, in floating-point columns, for NaN."""
    if isinstance(source, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def to_int(c: Column, source: T.DataType | None = None, bits: int = 64) -> Column:
    """Whole number, truncated toward zero; null on overflow."""
    source = source or T.StringType()
    if isinstance(source, T.StringType):
        # Decimal parsing is the strict check, is exact for all 64-bit numbers and truncates.
        value = F.when(c.rlike(r"^[\x00-\x7F]*$"), c.try_cast("decimal(38,18)")).try_cast("bigint")
    elif isinstance(source, (T.DoubleType, T.FloatType)):
        # The cast of a double saturates at exactly 2^63, hence the guard.
        real = c.cast("double")
        value = F.when(F.abs(real) < F.lit(9223372036854775808.0), real.try_cast("bigint"))
    elif isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        value = F.lit(None).cast("bigint")
    else:
        value = c.try_cast("bigint")
    return value.try_cast("int") if bits == 32 else value


def to_float(c: Column, source: T.DataType | None = None, bits: int = 64) -> Column:
    """Floating-point number; infinities survive, NaN becomes null."""
    source = source or T.StringType()
    if isinstance(source, T.StringType):
        value = F.when(c.rlike(_REAL), c.try_cast("double"))
    elif isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        value = F.lit(None).cast("double")
    else:
        value = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return value.cast("float") if bits == 32 else value


def _iso_text(c: Column) -> Column:
    """Rewrite every accepted spelling to ISO text, or null.

    One rewrite followed by one cast is cheaper than one pattern parser per
    spelling. The expression is kept short on purpose: a table has several such
    columns, and the JVM does not compile the generated method of a projection
    that grows beyond 8000 bytes of bytecode.
    """
    text = F.btrim(c, F.lit(" \t\r\n"))
    zoned = F.regexp_replace(F.regexp_replace(text, r"^(\d{8})([+\-Z])", "$1000000$2"), r"^(\d{12})([+\-Z])", "$100$2")
    separated = F.regexp_replace(F.regexp_replace(text, _MONTH_FIRST, "$3-$1-$2"), _YEAR_FIRST, "$1-$2-$3")
    filled = (
        F.when(text.rlike(_DIGITS), F.concat(text, F.substring(F.lit(_FILL), F.length(text) + 1, F.lit(14))))
        .when(text.rlike(_SEPARATED), separated)
        .when(text.rlike(_DIGITS_AND_ZONE), zoned)
    )
    return F.regexp_replace(filled, _FULL_DIGITS, _FULL_ISO)


def _spelled(c: Column, zone: bool) -> Column:
    """Timestamp of a further spelling, or null. Years of two digits from 69 on are of the last
    century. Without ``zone`` an offset is taken off first, so that it moves nothing."""

    def normal(text: Column) -> Column:
        text = F.btrim(F.regexp_replace(text, r"[,\s]+", " "))
        text = F.regexp_replace(text, r"^(\d{1,2}/\d{1,2}/)(69|[7-9]\d)(?= |$)", "$119$2")
        text = F.regexp_replace(text, r"^(\d{1,2}/\d{1,2}/)(\d{2})(?= |$)", "$120$2")
        return text if zone else F.regexp_replace(text, r"^(\d{8}T?\d{4,6})[+-]\d{2}:?\d{2}$", "$1")

    def read(text: Column) -> Column:
        known = F.lit(None).cast("string")
        spelled = _SPELLED if zone else (*_SPELLED, (r"^\d{12}$", "yyyyMMddHHmm"), (r"^\d{14}$", "yyyyMMddHHmmss"))
        for look, pattern in spelled:
            known = F.when(text.rlike(look), F.lit(pattern)).otherwise(known)
        return F.try_to_timestamp(text, known)

    # As array functions the text is made once, and none of this gets into generated code, which
    # would outgrow its limits; few texts come here. There is no year 0.
    found = F.filter(F.transform(F.transform(F.array(c), normal), read), lambda t: F.year(t) > 0)
    return F.when(c.rlike(r"\d\d"), F.get(found, F.lit(0)))


def _as_text(c: Column, source: T.DataType) -> Column:
    if isinstance(source, T.StringType):
        return c
    if isinstance(source, T.BooleanType):
        return F.lit(None).cast("string")
    return c.try_cast("bigint").cast("string")


def to_timestamp(c: Column, source: T.DataType | None = None, formats: Sequence[str] = ()) -> Column:
    """Instant. Text without an offset is local to the session time zone.

    ``formats`` are further patterns, tried after the built-in spellings.
    """
    source = source or T.StringType()
    if isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp")
    text = _as_text(c, source)
    rungs = [_iso_text(text).try_cast("timestamp")]
    rungs += [_spelled(text, zone=True)] if isinstance(source, T.StringType) else []
    rungs += [F.try_to_timestamp(F.trim(text), F.lit(f)) for f in formats]
    return F.coalesce(*rungs)


def to_date(c: Column, source: T.DataType | None = None, formats: Sequence[str] = ()) -> Column:
    """Calendar date as written: an offset never moves it to a neighbouring day."""
    source = source or T.StringType()
    if isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    text = _as_text(c, source)
    rungs = [_iso_text(text).try_cast("timestamp_ntz").cast("date")]
    rungs += [_spelled(text, zone=False).cast("date")] if isinstance(source, T.StringType) else []
    rungs += [F.try_to_timestamp(F.trim(text), F.lit(f)).cast("date") for f in formats]
    return F.coalesce(*rungs)


def to_str(c: Column, source: T.DataType | None = None) -> Column:
    """Text. Numbers, booleans and timestamps are spelled as Python's ``str`` does."""
    source = source or T.StringType()
    if isinstance(source, T.BooleanType):
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if isinstance(source, T.FloatType):
        # Python prints the float32 value widened; the JVM prints its shortest form.
        c, source = c.cast("double"), T.DoubleType()
    if isinstance(source, T.DoubleType):
        return _python_float_text(c)
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return (
            F.when(c.isNull(), F.lit(None).cast("string"))
            .when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        )
    return c.cast("string")


def _python_float_text(c: Column) -> Column:
    jvm = c.cast("string")
    size = F.abs(c)
    exponent = F.regexp_replace(F.regexp_replace(jvm, r"\.0E", "E"), "E", "e")
    exponent = F.regexp_replace(exponent, r"e(\d)", "e+$1")
    exponent = F.regexp_replace(exponent, r"e([+-])(\d)$", "e$10$2")
    plain = F.call_function("format_number", c, F.lit("0.0####################"))
    return (
        F.when(is_null(c, T.DoubleType()), F.lit(None).cast("string"))
        .when(size == F.lit(float("inf")), F.when(c > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), jvm)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(exponent)
    )


def cast_leniently(c: Column, source: T.DataType, target: T.DataType, formats: Sequence[str] = ()) -> Column:
    """Dispatch on the target type. Types outside the declared set become text."""
    if isinstance(target, T.LongType):
        return to_int(c, source)
    if isinstance(target, T.IntegerType):
        return to_int(c, source, bits=32)
    if isinstance(target, T.DoubleType):
        return to_float(c, source)
    if isinstance(target, T.FloatType):
        return to_float(c, source, bits=32)
    if isinstance(target, T.TimestampType):
        return to_timestamp(c, source, formats)
    if isinstance(target, T.DateType):
        return to_date(c, source, formats)
    return to_str(c, source)


def coerce_frame(df: DataFrame, types: Mapping[str, Any], formats: Sequence[str] = ()) -> DataFrame:
    """Cast each declared column leniently, in one projection.

    Declared columns the frame lacks are skipped; columns without a declaration,
    or with a type outside the known set, are left untouched.
    """
    declared = {name: spark_type(t) for name, t in types.items() if is_known_type(t)}
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if field.name in declared:
            c = cast_leniently(c, field.dataType, declared[field.name], formats).alias(field.name)
        columns.append(c)
    return df.select(*columns)
