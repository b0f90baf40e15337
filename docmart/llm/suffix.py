"""Substring dedup over bytes: strings of ``length`` bytes that start earlier as well.

Of distributed prefix doubling only the last steps are left: suffixes have to be told apart to a depth
of ``length`` bytes, only equality is asked for, and sorting rank pairs of every byte position is beyond
any budget (the README has the measured figure). So positions are first thinned by anchors
(``repeats.py``):

* at depth ``gram``, one position out of every stretch: unique ones drop out, and with them all
  suffixes whose first ``length`` bytes hold them;
* past ``length``, the bytes around those positions: classes that agree so far are settled;
* at ``length``, for every suffix that is left, a pair of names of half that depth.

Names are fingerprints of 64 bits, not dense ranks; buckets of them are dealt by Spark and sorted in
the tasks. A suffix whose name at ``length`` is there earlier is repeated; the bytes it covers go.

Cases: a null text is empty. Texts shorter than ``length`` lose nothing. Rows without an id lose
nothing and are no reference. Rows that repeat an id and text are one document: each gives its
row. A cut may fall inside a character: what is kept is bytes. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docmart.llm.common import flush, mix64, texts
from docmart.llm.repeats import find_repeats, with_places
from docmart.llm.rlz import spans_of
from docmart.operators.sift import sifted_join

VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
GRAM_SHARE = 0.4  # of the length: longer grams are rarer by chance, shorter ones need fewer anchors


def byte_values(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A random value per byte, and the documents' bounds."""
    bounds = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    return VALUES[np.frombuffer(b"".join(docs), np.uint8)], bounds


def duplicate_spans(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)``: half-open spans of bytes to remove, and the other bytes."""
    rows = texts(docs, id_col, text_col)
    found = find_repeats(rows, byte_values, length, max(1, int(GRAM_SHARE * length)), within=True)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", span), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for doc_id, data, place, count in with_places(batches):
            first, last = (x.tolist() for x in spans_of(place, count, length))
            kept = b"".join(data[a:b] for a, b in zip([0, *last], [*first, len(data)], strict=True))
            out.append((doc_id, len(data), [{"start": a, "end": b} for a, b in zip(first, last, strict=True)], kept))
            size += len(kept)
            if size > 1 << 24:
                yield flush(schema, out)
                size = 0
        yield flush(schema, out)

    return sifted_join(rows, found, "doc_id").mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
