"""Language identification of mixed-language text.

A word is scored by the byte trigrams around each of its letters, under one smoothed model per
language. The scripts of its letters narrow the candidates: a language that was never seen in a
script is out for a word in it (where no language was, the word decides nothing). Viterbi over
the words, with a penalty for switching, labels spans; the language of most letters is the
document's.

Trigram and script counts cover all training documents and are summed by Spark; a model has
``2**16`` trigram classes and ``len(SCRIPTS)`` scripts for a language, whatever the corpus.
Documents are scored in chunks, all of a chunk one word further at each step.

Cases: a null text, an empty one or one without a letter is ``und`` with score 0, and so is
every text if nothing can be learnt. A null ``doc_id`` is held out; a null language teaches
nothing. Ties go to the language first in alphabetical order. Repeated rows give a row each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import flush, held_out, rows_of

CLASSES = 1 << 16
CHUNK_BYTES = 1 << 21
PENALTY = 12.0  # nats for a change of language between words
SCRIPT_SHARE = 0.001  # of a language's letters in a script, for it to be a candidate there

# The first UTF-8 byte of the letters of a script (Unicode blocks).
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC9)],
    "greek": [(0xCD, 0xCF)],
    "cyrillic": [(0xD0, 0xD4)],
    "hebrew": [(0xD6, 0xD7)],
    "arabic": [(0xD8, 0xDB)],
    "indic": [(0xE0, 0xE0)],
    "south-east asian": [(0xE1, 0xE1)],
    "kana and han": [(0xE3, 0xE9)],
    "hangul": [(0xEA, 0xED)],
}

_LETTER = re.compile(r"[^\W\d_]")


def _script_table() -> np.ndarray:
    out = np.zeros(256, np.int8)  # 0: no letter's first byte, or a byte that tells nothing
    for i, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            out[a : b + 1] = i
    return out


SCRIPT_OF = _script_table()
_IN_WORD = np.array([0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


class Letters(NamedTuple):
    """The words of a chunk of documents, letter by letter."""

    classes: np.ndarray  # trigram class of each letter byte
    scripts: np.ndarray
    word_starts: np.ndarray  # into the letters
    doc_words: np.ndarray  # words of each document


def letters(docs: list[str]) -> Letters:
    parts = [b" " + d.lower().encode("utf-8", "replace") for d in docs]
    raw = np.frombuffer(b"".join(parts) + b" ", np.uint8)
    inside = _IN_WORD[raw]
    clean = np.where(inside, raw, 0x20).astype(np.uint32)
    at = np.flatnonzero(inside)
    triple = (clean[at - 1] << 16) | (clean[at] << 8) | clean[at + 1]
    classes = (triple * np.uint32(2654435761)) >> np.uint32(16)
    starts = np.flatnonzero(~inside[at - 1])
    ends = np.cumsum([len(p) for p in parts])
    upto = np.searchsorted(at[starts], ends)
    return Letters(classes, SCRIPT_OF[raw[at]], starts, np.diff(np.concatenate(([0], upto))))


def chunks(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in rows_of(batches, *columns):
        held.append(row)
        size += len(row[-1] or "")
        if size >= CHUNK_BYTES or len(held) >= 4096:
            yield held
            held, size = [], 0
    if held:
        yield held


class Model(NamedTuple):
    langs: list[str]
    logs: np.ndarray  # class by language
    allowed: np.ndarray  # script by language


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts of all documents that are not held out and name their language."""
    ids = F.col(id_col).cast("long")
    taught = docs.where(~held_out(ids) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    taught = taught.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    width = CLASSES + len(SCRIPTS) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for rows in chunks(batches, "lang", "text"):
            by_lang: dict[str, list] = {}
            for lang, text in rows:
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                found = letters(own)
                sums = total.setdefault(lang, np.zeros(width, np.int64))
                sums[:CLASSES] += np.bincount(found.classes, minlength=CLASSES)
                sums[CLASSES:] += np.bincount(found.scripts, minlength=len(SCRIPTS) + 1)
        for lang, sums in total.items():
            at = np.flatnonzero(sums)
            yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["lang", "at", "n"])

    rows = taught.mapInArrow(count, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r.lang for r in rows})
    counts = np.zeros((width, len(langs)))
    for r in rows:
        counts[r.at, langs.index(r.lang)] = r.n
    grams, scripts = counts[:CLASSES], counts[CLASSES:]
    logs = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * CLASSES)).astype(np.float32)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(1, scripts[1:].sum(axis=0))
    allowed[0] = True
    return Model(langs, logs, allowed)


def word_scores(found: Letters, model: Model) -> np.ndarray:
    """Word by language."""
    out = np.add.reduceat(model.logs[found.classes], found.word_starts, axis=0)
    script = np.maximum.reduceat(found.scripts, found.word_starts)
    open_ = model.allowed[script]
    none = ~open_.any(axis=1)
    out[~open_] = -1e6
    out[none] = 0
    return out


def viterbi(scores: np.ndarray, doc_words: np.ndarray, penalty: float) -> np.ndarray:
    """The language number of each word, best over each document."""
    order = np.argsort(-doc_words, kind="stable")
    size = doc_words[order]
    first = (np.cumsum(doc_words) - doc_words)[order]
    n_langs = scores.shape[1]
    own = np.arange(n_langs, dtype=np.int16)
    steps = int(size[0]) if len(size) else 0
    active = len(size) - np.searchsorted(size[::-1], np.arange(steps), side="right")
    back = np.empty((len(scores), n_langs), np.int16)
    best = np.zeros((len(size), n_langs), np.float32)
    for t in range(steps):
        n = active[t]
        at = first[:n] + t
        v = best[:n]
        if t:
            switch = (v.max(axis=1) - penalty)[:, None]
            back[at] = np.where(v >= switch, own, v.argmax(axis=1)[:, None])
            v = np.maximum(v, switch)
        best[:n] = v + scores[at]
    path = np.empty(len(scores), np.int16)
    state = best.argmax(axis=1).astype(np.int16)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = first[:n] + t
        path[at] = state[:n]
        if t:
            state[:n] = back[at, state[:n]]
    return path


def label(docs: list[str | None], model: Model, penalty: float = PENALTY) -> list[tuple[str, float, list[dict]]]:
    """Language, score and spans ``[start, end)`` of words of each text."""
    found = letters([d or "" for d in docs])
    if not len(found.word_starts) or not model.langs:
        return [("und", 0.0, []) for _ in docs]
    path = viterbi(word_scores(found, model), found.doc_words, penalty)
    length = np.diff(np.append(found.word_starts, len(found.classes)))
    ends = np.cumsum(found.doc_words)
    doc = np.repeat(np.arange(len(docs)), found.doc_words)
    share = np.bincount(doc * len(model.langs) + path, length, len(docs) * len(model.langs)).reshape(len(docs), -1)
    new = np.concatenate(([True], (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])))
    cuts = np.flatnonzero(new)
    spans: list[list] = [[] for _ in docs]
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(path)).tolist(), strict=True):
        d = int(doc[a])
        base = int(ends[d] - found.doc_words[d])
        spans[d].append({"start": a - base, "end": b - base, "lang": model.langs[path[a]]})
    top, total = share.argmax(axis=1), share.sum(axis=1)
    return [
        (model.langs[top[i]], float(share[i, top[i]] / total[i]), spans[i]) if total[i] and _LETTER.search(text) else ("und", 0.0, [])
        for i, text in enumerate(d or "" for d in docs)
    ]


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, spans)``."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", span)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches, "doc_id", "text"):
            ids, own = zip(*rows, strict=True)
            yield flush(schema, [(i, *x) for i, x in zip(ids, label(list(own), shared.value, penalty), strict=True)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")
