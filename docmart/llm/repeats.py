"""Repeated stretches of token sequences: what the two substring operators share.

Every stretch of ``length`` tokens is represented by one anchor inside it: of its grams of
``gram`` tokens the leftmost with the smallest hash. Equal stretches have equal anchors at equal
offsets, so only occurrences of the same anchor need to be compared, and an anchor seen once
rules out all stretches around it. Neighbouring stretches mostly share their anchor, which
leaves about ``2 / (length - gram + 2)`` anchors per token.

Hashes of stretches are polynomial, modulo ``2**64``, over random 64-bit values of tokens; two
independent ones together name a stretch.

``find_repeats`` then works in two exchanges of packed arrays, each dealt by a hash.

1. Anchors. Of occurrences with the same surroundings (all that its stretches cover) only the
   first stays open: every later one is repeated whole. An anchor whose first occurrences
   have different surroundings is at the edge of a repeat, or of several.
2. Single stretches around those edges, named by the ranks of their two halves.

Before an exchange each task settles what it can among its own rows. A later occurrence never
travels, so a key that a third of all documents share sends one row per task at most. An
anchor that a task has seen in different surroundings is known to be an edge there and sends
only that news.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import mix64, stage
from docmart.operators.sift import sift

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so that powers have inverses
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            factors = np.full(size, b, np.uint64)
            factors[0] = 1
            both.append(np.multiply.accumulate(factors))
        _powers[base] = (both[0], both[1])
    up, down = _powers[base]
    return up[:n], down[:n]


class Hashes:
    """Hashes of any stretch of a sequence in constant time."""

    def __init__(self, values: np.ndarray, family: int = 0):
        up, self.down = _power_tables(BASES[family], len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def all(self, length: int) -> np.ndarray:
        """Of every stretch of a length."""
        n = len(self.sums) - length
        return mix64((self.sums[length:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)


class Anchors(NamedTuple):
    doc: np.ndarray  # number of the document in the chunk
    first: np.ndarray  # first stretch it stands for, as a position in the document
    count: np.ndarray  # number of stretches, which start one after the other
    gram: np.ndarray  # hash of the anchor's gram
    context: np.ndarray  # hash of all that its stretches cover, and where the anchor is in it


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def anchors(values: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> Anchors:
    """Of a chunk of documents, document ``i`` being ``values[bounds[i]:bounds[i + 1]]``."""
    none = np.zeros(0, np.int64)
    if len(values) < length:
        return Anchors(none, none, none, none.view(np.uint64), none.view(np.uint64))
    hashes = Hashes(values)
    grams = hashes.all(gram)
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    at = (sliding_min(key, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Only stretches within a document count; anchors of those lie in it as well.
    inside = np.zeros(len(values) + 1, np.int32)
    sizes = np.diff(bounds)
    some = sizes >= length
    np.add.at(inside, bounds[:-1][some], 1)
    np.add.at(inside, (bounds[1:] - length + 1)[some], -1)
    starts = np.flatnonzero(np.cumsum(inside)[: len(at)])
    if not len(starts):
        return Anchors(none, none, none, none.view(np.uint64), none.view(np.uint64))
    own = at[starts]
    new = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    first, anchor = starts[new], own[new]
    count = np.diff(np.append(new, len(starts)))
    doc = np.searchsorted(bounds, first, side="right") - 1
    shape = (anchor - first).astype(np.uint64) * np.uint64(0x1F3D5B79A3C1E5F7) + count.astype(np.uint64)
    context = mix64(hashes.of(first, first + count + length - 1) + mix64(shape))
    return Anchors(doc, first - bounds[doc], count, grams[anchor], context)


Tokens = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]  # random values and bounds

CHUNK_BYTES = 1 << 18
BUCKET_BYTES = 1 << 21  # of the stored table: what a bucket holds is settled in memory
MOST_BUCKETS = 1 << 16
HOLD_ROWS = 1 << 18  # rows that a task settles together
MULTI, SINGLE, MARK = 0, 1, 2
FACTOR, EDGE = 0, 1


def _chunks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def with_places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(doc_id, data, place, count)`` of rows ``(doc_id, data, array of (place, count))``, the last two as
    arrays; a null array is empty. Values are taken one by one and never as a list of all."""
    for batch in batches:
        lists = batch.column(2)
        cuts = lists.offsets.to_numpy().tolist()
        place, count = (lists.values.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
        for doc_id, data, a, b in zip(batch.column(0), batch.column(1), cuts[:-1], cuts[1:], strict=True):
            yield doc_id.as_py(), data.as_py(), place[a:b], count[a:b]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for doc_id, data in zip(batch.column(0), batch.column(1), strict=True):
            yield doc_id.as_py(), data.as_py()


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _later(new: np.ndarray, doc: np.ndarray, within: bool) -> np.ndarray:
    """Rows that have an earlier one of their group: in a smaller document, or, if ``within``
    one as well, further up. Rows are sorted by group, document and place."""
    return ~new if within else doc > doc[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]


def _same_place(new: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rows that repeat the place of the row before: the document itself is there twice."""
    twin = np.zeros(len(new), bool)
    twin[1:] = ~new[1:] & (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])
    return twin


def _pack(column: np.ndarray) -> bytes:
    """All first bytes, then all second ones: leading zeros lie together and compress."""
    return np.ascontiguousarray(column).view(np.uint8).reshape(len(column), column.itemsize).T.tobytes()


def _unpack(cell: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(cell, np.uint8).reshape(size, len(cell) // size).T).view(dtype).reshape(-1)


def _message(kind: int, bucket: int, *columns: np.ndarray) -> tuple:
    return (bucket, kind, *map(_pack, columns))


_KINDS = (np.uint64, np.uint64, np.int64, np.uint32, np.uint32)
_NAMES = ["bucket", "kind", "a", "b", "doc", "place", "count"]
_DDL = "bucket int, kind int, a binary, b binary, doc binary, place binary, count binary"


def _send(messages: list[tuple]) -> Iterator[pa.RecordBatch]:
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 5
    for i in range(0, len(messages), 64):
        part = messages[i : i + 64]
        yield pa.record_batch([pa.array([m[k] for m in part], t) for k, t in enumerate(types)], names=_NAMES)


def _deal(kind: int, a: np.ndarray, b: np.ndarray, doc: np.ndarray, place: np.ndarray, count: np.ndarray, n: int) -> list[tuple]:
    """One message per bucket; the bucket is the high bits of ``a``, so sorted rows stay together."""
    bucket = ((a >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(bucket, np.arange(n + 1))
    full = np.flatnonzero(cuts[1:] > cuts[:-1]).tolist()
    columns = [c.astype(k, copy=False) for c, k in zip((a, b, doc, place, count), _KINDS, strict=True)]
    return [_message(kind, i, *(c[cuts[i] : cuts[i + 1]] for c in columns)) for i in full]


def _marks(doc: np.ndarray, place: np.ndarray, count: np.ndarray, bucket: int, edge: int) -> tuple:
    nothing = np.full(len(doc), edge, np.uint64)
    return _message(MARK, bucket, nothing, nothing[:0], doc, place.astype(np.uint32), count.astype(np.uint32))


def _read(part: pa.Table, kind: int) -> list[np.ndarray]:
    own = [i for i, k in enumerate(part.column("kind").to_pylist()) if k == kind]
    out = []
    for name, dtype in zip(_NAMES[2:], _KINDS, strict=True):
        cells = part.column(name)
        out.append(np.concatenate([_unpack(cells[i].as_py(), dtype) for i in own] or [np.zeros(0, dtype)]))
    return out


_FOUND = "doc_id long, place long, count long, edge int"


def _found(groups: list[tuple]) -> pa.Table:
    doc, place, count, edge = (np.concatenate([np.asarray(g[i], np.int64) for g in groups] or [np.zeros(0, np.int64)]) for i in range(4))
    return pa.table({"doc_id": doc, "place": place, "count": count, "edge": edge.astype(np.int32)})


def _sorted(a, b, doc, place, count):
    order = np.lexsort((place, doc, b, a))
    return a[order], b[order], doc[order], place[order], count[order]


def _runs(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Single places as runs of neighbours."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order].astype(np.int64)
    new = np.flatnonzero(_starts(doc, place - np.arange(len(place))))
    return doc[new], place[new], np.diff(np.append(new, len(place)))


def _anchor_messages(docs: DataFrame, tokens: Tokens, length: int, gram: int, within: bool, n: int) -> DataFrame:
    def settle(held: list[tuple], turn: int) -> Iterator[pa.RecordBatch]:
        gram_, context, doc, place, count = _sorted(*(np.concatenate([h[i] for h in held]) for i in range(5)))
        new = _starts(gram_, context)
        twin = _same_place(new, doc, place)
        later = _later(new, doc, within) & ~twin
        heads = np.flatnonzero(_starts(gram_))
        contexts = np.add.reduceat(new.astype(np.int64), heads)
        multi = np.repeat(contexts > 1, np.diff(np.append(heads, len(gram_))))
        edge, single = ~later & ~twin & multi, ~later & ~twin & ~multi
        news = gram_[heads[contexts > 1]]
        zero = np.zeros(len(news), np.int64)
        messages = _deal(SINGLE, gram_[single], context[single], doc[single], place[single], count[single], n)
        messages += _deal(MULTI, news, zero, zero, zero, zero, n)
        messages.append(_marks(doc[later], place[later], count[later], turn % n, FACTOR))
        messages.append(_marks(doc[edge], place[edge], count[edge], turn % n, EDGE))
        return _send(messages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        waiting = turn = 0
        for rows in _chunks(_cells(batches)):
            ids = np.array([r[0] for r in rows], np.int64)
            found = anchors(*tokens([r[1] for r in rows]), length, gram)
            if len(found.doc):
                turn = turn or int(found.gram[0] & np.uint64(0x7FFFFFFF))
                held.append((found.gram, found.context, ids[found.doc], found.first.astype(np.uint32), found.count.astype(np.uint32)))
                waiting += len(found.doc)
            if waiting >= HOLD_ROWS:
                yield from settle(held, turn)
                held, waiting, turn = [], 0, turn + 1
        if held:
            yield from settle(held, turn)

    return docs.mapInArrow(run, _DDL)


def _settle_anchors(messages: DataFrame, within: bool) -> DataFrame:
    def run(part: pa.Table) -> pa.Table:
        edges, _, doc, place, count = _read(part, MARK)
        out = [(doc, place, count, edges)]
        gram_, context, doc, place, count = _sorted(*_read(part, SINGLE))
        if len(gram_):
            new = _starts(gram_, context)
            later = _later(new, doc, within) & ~_same_place(new, doc, place)
            heads = _starts(gram_)
            contexts = np.bincount(np.cumsum(heads) - 1, new)
            several = (contexts > 1) | np.isin(gram_[heads], _read(part, MULTI)[0])
            edge = ~later & several[np.cumsum(heads) - 1]
            for rows, kind in ((later, FACTOR), (edge, EDGE)):
                out.append((doc[rows], place[rows], count[rows], np.full(int(rows.sum()), kind)))
        return _found(out)

    return messages.groupBy("bucket").applyInArrow(run, _FOUND)


def _stretch_messages(docs: DataFrame, tokens: Tokens, length: int, within: bool, n: int) -> DataFrame:
    half = length // 2

    def settle(held: list[tuple], turn: int) -> Iterator[pa.RecordBatch]:
        low, high, doc, place = (np.concatenate([h[i] for h in held]) for i in range(4))
        low, high, doc, place, _ = _sorted(low, high, doc, place, place)
        new = _starts(low, high)
        twin = _same_place(new, doc, place)
        later = _later(new, doc, within) & ~twin
        stays = ~later & ~twin
        messages = _deal(SINGLE, low[stays], high[stays], doc[stays], place[stays], np.zeros(0, np.uint32), n)
        return _send([*messages, _marks(*_runs(doc[later], place[later]), turn % n, FACTOR)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        waiting = turn = 0
        for rows in _chunks(with_places(batches)):
            ids = np.array([r[0] for r in rows], np.int64)
            values, bounds = tokens([r[1] for r in rows])
            of_row = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
            first, count = (np.concatenate([r[i] for r in rows]) for i in (2, 3))
            within_run = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            place = np.repeat(first, count) + within_run
            owner = np.repeat(of_row, count)
            at = bounds[owner] + place
            low, high = Hashes(values).of(at, at + half), Hashes(values, 1).of(at + half, at + length)
            # Dealt by both halves: many stretches share one half where a repeat ends.
            held.append((mix64(low + mix64(high)), low, ids[owner], place.astype(np.uint32)))
            waiting += len(at)
            if len(at):
                turn = turn or int(held[-1][0][0] & np.uint64(0x7FFFFFFF))
            if waiting >= HOLD_ROWS:
                yield from settle(held, turn)
                held, waiting, turn = [], 0, turn + 1
        if waiting:
            yield from settle(held, turn)

    return docs.mapInArrow(run, _DDL)


def _settle_stretches(messages: DataFrame, within: bool) -> DataFrame:
    def run(part: pa.Table) -> pa.Table:
        _, _, doc, place, count = _read(part, MARK)
        low, high, own, at, _ = _read(part, SINGLE)
        low, high, own, at, _ = _sorted(low, high, own, at, at)
        new = _starts(low, high)
        later = _later(new, own, within) & ~_same_place(new, own, at)
        d, p, c = _runs(own[later], at[later])
        return _found([(doc, place, count, np.zeros(len(doc))), (d, p, c, np.zeros(len(d)))])

    return messages.groupBy("bucket").applyInArrow(run, _FOUND)


def n_buckets(docs: DataFrame) -> int:
    """Two for each shuffle partition, and more for tables whose stored size asks for it."""
    stored = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(stored // BUCKET_BYTES, MOST_BUCKETS)) if stored < 1 << 60 else least


def find_repeats(docs: DataFrame, tokens: Tokens, length: int, gram: int, within: bool) -> DataFrame:
    """``(doc_id, found)``: for documents with repeated stretches of ``length`` tokens, runs of their
    starts as an array of ``(place, count)``. A stretch is repeated if it also starts in a document
    with a smaller id, or, if ``within``, further up in the same one. ``docs`` is ``(doc_id, data)``;
    rows without an id neither repeat nor are repeated."""
    n = n_buckets(docs)
    known = docs.where("doc_id is not null")
    found = stage(_settle_anchors(_anchor_messages(known, tokens, length, gram, within, n), within), "anchors")
    one = F.struct("place", "count")
    edges = found.where(f"edge = {EDGE}").groupBy("doc_id").agg(F.collect_set(one).alias("edges"))
    # Texts without an edge are settled and stay where they are.
    near = sift(known, "doc_id", found.where(f"edge = {EDGE}").select("doc_id").distinct())
    open_ = near.where("__may").drop("__may").join(edges, "doc_id")
    single = _settle_stretches(_stretch_messages(open_, tokens, length, within, n), within)
    both = found.where(f"edge = {FACTOR}").union(single)
    return stage(both.groupBy("doc_id").agg(F.collect_set(one).alias("found")), "repeats")
