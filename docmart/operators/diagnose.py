"""Why a refused document is no well-formed XML: the parser's own words and the place."""

from __future__ import annotations

from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNREADABLE = "unreadable"
SCHEMA = pa.schema([("file_name", pa.string()), ("message", pa.string()), ("cause", pa.string()), ("line", pa.int32()), ("column", pa.int32())])


def cause_of(xml: str | None) -> tuple[str | None, int | None, int | None]:
    """The first error of a strict parse: what, line and column, both from 1; nulls if there is none.
    External entities are never read."""
    if xml is None:
        return UNREADABLE, None, None
    parser = expat.ParserCreate()
    try:
        parser.Parse(xml.encode("utf-8", "surrogatepass"), True)
    except expat.ExpatError as e:
        return expat.ErrorString(e.code), e.lineno, e.offset + 1
    return None, None, None


def diagnose(quarantined: DataFrame) -> DataFrame:
    """``file_name, message, cause, line, column`` of documents set aside (``quarantine``).

    A second parse, of refused documents only. ``cause`` is null where a strict parse finds nothing
    wrong: then the document was refused for what a table needs and not for its syntax.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [cause_of(xml.as_py()) for xml in batch.column(2)]
            cells = list(zip(*found, strict=True)) or [(), (), ()]
            columns = [pa.array(c, t) for c, t in zip(cells, SCHEMA.types[2:], strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], schema=SCHEMA)

    ddl = "file_name string, message string, cause string, line int, column int"
    return quarantined.select("file_name", "message", "xml").mapInArrow(run, ddl)


def causes(diagnosed: DataFrame) -> DataFrame:
    """``cause, n`` by falling count; the message where a parse finds no cause."""
    return diagnosed.groupBy(F.coalesce("cause", "message").alias("cause")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "cause")
