"""Substring dedup: windows of words that earlier documents hold.

This is not a relative Lempel-Ziv parse: there are no factors of greatest length and no reference
positions. All stretches that could repeat are found by anchors and joined by hashes
(``repeats.py``): where the words around an anchor equal those around an earlier one, all
windows there are repeated; where they differ, every single window is looked up. The README says
why. Equality is that of two independent 64-bit hashes.

Words are the runs between 0x20 and 0x09-0x0D, unchanged.

Cases: a null text has no words. Documents with fewer than ``window`` words lose none. Rows
without an id lose none and are no reference. Rows that repeat an id and text are one document:
each gives its row. Repeats within a document stay. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from xxhash import xxh3_64_intdigest

from docmart.llm.common import flush, merge_runs, texts
from docmart.llm.repeats import find_repeats, with_places
from docmart.operators.sift import sifted_join


def words(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A random value per word, and the documents' bounds."""
    parts = [d.split() for d in docs]
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    values = np.fromiter((xxh3_64_intdigest(w) for p in parts for w in p), np.uint64, int(bounds[-1]))
    return values, bounds


def spans_of(place: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of starts as disjoint spans of tokens."""
    end = place + count + length - 1
    order = np.argsort(place, kind="stable")
    return merge_runs(place[order], end[order])


def duplicate_spans(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, spans, kept_text)``: half-open spans of words to remove, and the other
    words joined by one space."""
    rows = texts(docs, id_col, text_col)
    found = find_repeats(rows, words, window, window // 2, within=False)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", span), ("kept_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for doc_id, data, place, count in with_places(batches):
            parts = data.split()
            n, spans = len(parts), []
            if len(place):
                first, last = (x.tolist() for x in spans_of(place, count, window))
                spans = [{"start": a, "end": b} for a, b in zip(first, last, strict=True)]
                parts = [w for a, b in zip([0, *last], [*first, n], strict=True) for w in parts[a:b]]
            kept = b" ".join(parts)
            out.append((doc_id, n, spans, kept))
            size += len(kept)
            if size > 1 << 24:
                yield flush(schema, [(i, m, s, k.decode("utf-8", "replace")) for i, m, s, k in out])
                out, size = [], 0
        yield flush(schema, [(i, m, s, k.decode("utf-8", "replace")) for i, m, s, k in out])

    return sifted_join(rows, found, "doc_id").mapInArrow(run, "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept_text string")

