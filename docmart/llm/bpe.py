"""Byte-level BPE encoding and decoding.

A text is cut into pre-tokens by a pattern, and each is encoded alone. Two tiers resolve them:

1. A minimal perfect hash over the vocabulary's byte strings: as many slots as tokens, a
   displacement per bucket. A pre-token that is a token takes one probe, verified by its bytes.
   All distinct pre-tokens of a block are probed at once.
2. A miss is merged from its bytes, kept as a linked list: a heap yields the pair of lowest rank,
   the leftmost of equals; pairs that a merge has changed are stale and passed over. A pre-token
   of n bytes takes O(n log n), however long.

The vocabulary (token bytes and ranks; ranks are the ids) is broadcast: its size is that of the
tokenizer's file. Texts are never shuffled; a long text is encoded block by block.

Cases: a null text is empty and has no ids. Bytes that are no UTF-8 are read as U+FFFD. A null
``doc_id`` stays null. Repeated rows are encoded each. A null list of ids decodes to nothing, null
ids in it are left out; an id outside the vocabulary is an error. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from xxhash import xxh3_64_intdigest

from docmart.llm.common import mix64, texts

LOAD = 4  # tokens per bucket of the hash, on average
TRIES = 256  # displacements tried at once
BLOCK = 1 << 18  # pre-tokens resolved at once
KNOWN = 1 << 18  # distinct pre-tokens whose ids a task remembers before it starts anew
LONG = 1 << 20  # characters from which a text is a block of its own
_STEP = np.uint64(0x9E3779B97F4A7C15)


class PerfectHash:
    """A minimal perfect hash: ``slots(hashes)`` is a bijection of the keys it was built of."""

    def __init__(self, hashes: np.ndarray):
        n = self.n = len(hashes)
        if len(np.unique(hashes)) != n:
            raise ValueError("two keys have the same 64-bit hash")
        self.buckets = max(1, n // LOAD)
        self.shift = np.zeros(self.buckets, np.int64)
        own = self._bucket(hashes)
        order = np.argsort(own, kind="stable")
        cuts = np.searchsorted(own[order], np.arange(self.buckets + 1))
        sizes = np.diff(cuts)
        free = np.ones(n, bool)
        for b in np.argsort(-sizes, kind="stable").tolist():
            keys = hashes[order[cuts[b] : cuts[b + 1]]]
            if len(keys) < 2:
                break
            start = 0
            while True:  # the first displacement that sends the bucket to free and different slots
                places = self._displaced(keys[None, :], np.arange(start, start + TRIES)[:, None])
                fits = free[places].all(axis=1)
                sorted_ = np.sort(places, axis=1)
                fits &= (sorted_[:, 1:] != sorted_[:, :-1]).all(axis=1)
                if fits.any():
                    first = int(fits.argmax())
                    self.shift[b] = start + first
                    free[places[first]] = False
                    break
                start += TRIES
        alone = np.flatnonzero(sizes == 1)  # single keys name the slots that are left
        self.shift[alone] = -1 - np.flatnonzero(free)

    def _bucket(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int64)

    def _displaced(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix64(hashes + shift.astype(np.uint64) * _STEP) % np.uint64(max(self.n, 1))).astype(np.int64)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        shift = self.shift[self._bucket(hashes)]
        return np.where(shift < 0, -1 - shift, self._displaced(hashes, np.maximum(shift, 0)))


class Vocabulary:
    """Tokens by id and the hash that finds them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for the bytes {missing}")
        self.ranks, self.pattern = ranks, pattern
        self.token_of = {i: t for t, i in ranks.items()}
        # Ranks of pairs of single bytes, by both bytes; -1 where they do not merge.
        self.pairs = [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
        tokens = list(ranks)
        hashes = np.fromiter(map(xxh3_64_intdigest, tokens), np.uint64, len(tokens))
        self.hash = PerfectHash(hashes)
        at = self.hash.slots(hashes)
        self.slot_tokens = np.empty(len(tokens), object)
        self.slot_tokens[at] = np.array([*tokens, None], object)[:-1]
        self.slot_ids = np.zeros(len(tokens), np.int64)
        self.slot_ids[at] = np.fromiter(ranks.values(), np.int64, len(tokens))

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """A file of ``base64(token) rank`` lines."""
        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def whole(self, pieces: list[bytes]) -> list[int]:
        """First tier: the id of each piece, or -1."""
        if not pieces:
            return []
        at = self.hash.slots(np.fromiter(map(xxh3_64_intdigest, pieces), np.uint64, len(pieces)))
        there = self.slot_tokens[at].tolist()
        return [i if t == p else -1 for p, t, i in zip(pieces, there, self.slot_ids[at].tolist(), strict=True)]

    def merged(self, piece: bytes) -> list[int]:
        """Second tier: merges of lowest rank first. A heap entry holds a rank, where the left part
        starts and where the right one ends, in one number that orders by rank, then by place."""
        n, rank_of, pairs, pop, push = len(piece), self.ranks.get, self.pairs, heapq.heappop, heapq.heappush
        bits = n.bit_length()
        mask = (1 << bits) - 1
        after = list(range(1, n + 1))  # where the part that starts here ends; 0: it starts no more
        before = list(range(-1, n - 1))
        found = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]
        heap = [(r << bits | i) << bits | i + 2 for i, r in enumerate(found) if r >= 0]
        heapq.heapify(heap)
        while heap:
            entry = pop(heap)
            end, left = entry & mask, entry >> bits & mask
            right = after[left]
            if not right or right >= n or after[right] != end:
                continue  # one of the two has grown or gone since
            after[left], after[right] = end, 0
            if end < n:
                before[end] = left
                r = rank_of(piece[left : after[end]])
                if r is not None:
                    push(heap, (r << bits | left) << bits | after[end])
            if left:
                prior = before[left]
                r = rank_of(piece[prior:end])
                if r is not None:
                    push(heap, (r << bits | prior) << bits | end)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def resolve(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has."""
        raw = [p.encode("utf-8") for p in pieces]
        found = [[i] if i >= 0 else self.merged(p) for p, i in zip(raw, self.whole(raw), strict=True)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum())), sizes

    def encode_all(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        """``(key, text)`` to ``(key, ids)``, in order."""
        find = regex.compile(self.pattern)
        index: defaultdict[str, int] = defaultdict()  # distinct pieces, numbered as they come
        index.default_factory = index.__len__
        none = np.zeros(0, np.int64)
        ids, sizes, first = none.astype(np.int32), none, none  # of the pieces resolved so far
        held: list[tuple] = []
        waiting = 0

        def codes(pieces: list[str]) -> np.ndarray:
            return np.fromiter(map(index.__getitem__, pieces), np.int64, len(pieces))

        def settled(parts: list[np.ndarray]) -> list[np.ndarray]:
            nonlocal ids, sizes, first
            new_ids, new_sizes = self.resolve(list(islice(index, len(sizes), None)))
            ids, sizes = np.concatenate((ids, new_ids)), np.concatenate((sizes, new_sizes))
            first = np.cumsum(sizes) - sizes
            every = np.concatenate(parts) if parts else none
            n = sizes[every]
            ends = np.cumsum(n)
            flat = ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first[every] - (ends - n), n)]
            cuts = np.concatenate(([0], ends))[np.cumsum([0, *map(len, parts)])].tolist()
            if len(index) > KNOWN:
                index.clear()
                ids, sizes = ids[:0], sizes[:0]
            return [flat[a:b] for a, b in pairwise(cuts)]

        def finished() -> Iterator[tuple]:
            yield from zip([k for k, _ in held], settled([c for _, c in held]), strict=True)
            held.clear()

        for key, text in rows:
            if len(text) < LONG:
                held.append((key, codes(find.findall(text))))
                waiting += len(held[-1][1])
                if waiting >= BLOCK:
                    yield from finished()
                    waiting = 0
                continue
            yield from finished()
            waiting = 0
            pieces = (m.group() for m in find.finditer(text))
            parts = []
            while block := list(islice(pieces, BLOCK)):
                parts += settled([codes(block)])
            yield key, np.concatenate(parts)
        yield from finished()


SEND_BYTES = 1 << 23  # of an Arrow batch that a task sends


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: the token ids of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def batch_of(held: list[tuple]) -> pa.RecordBatch:
        ends = np.cumsum([0, *(len(ids) for _, ids in held)])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([ids for _, ids in held]), pa.int32()))
        return pa.record_batch([pa.array([k for k, _ in held], pa.int64()), ids], names=["doc_id", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Value by value: a list of all texts of a batch would hold it twice.
        cells = (cell for b in batches for cell in zip(b.column(0), b.column(1), strict=True))
        rows = ((key.as_py(), data.as_py().decode("utf-8", "replace")) for key, data in cells)
        held, size = [], 0
        for key, ids in shared.value.encode_all(rows):
            held.append((key, ids))
            size += 4 * len(ids) + 16
            if size >= SEND_BYTES:
                yield batch_of(held)
                held, size = [], 0
        if held:
            yield batch_of(held)

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(doc_id, n_tokens, packed, data)`` of ``(doc_id, ids)``: the ids as little-endian unsigned
    32-bit integers, as files of training tokens hold them, and the bytes they stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["doc_id", "n_tokens", "packed", "data"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.token_of.__getitem__
        for batch in batches:
            rows, size = [], 0
            lists = batch.column(1).fill_null([])
            for key, ids in zip(batch.column(0), lists, strict=True):
                known = ids.values.drop_null().to_numpy(zero_copy_only=False)
                rows.append((key.as_py(), len(known), known.astype("<u4").tobytes(), b"".join(map(token, known.tolist()))))
                size += len(rows[-1][2]) + len(rows[-1][3])
                if size >= SEND_BYTES:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, packed binary, data binary")
