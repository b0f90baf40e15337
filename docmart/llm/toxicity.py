"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the bag has a label. A sentence scores
``p = sigmoid(BIAS + sum of its features' weights)``, and 0 without a feature, so that a long text
is no more suspect than a short one; the document is toxic unless every sentence is harmless:
``P = 1 - (1 - leak) * prod(1 - p)`` (leaky noisy-or; the leak stands for labels that nothing in
the text explains). Weights and the leak are fitted on the documents' labels; afterwards the
sentences' own ``p`` locate the offence.

One parameter bounds the fit, and nothing else is bounded: ``MAX_FIT``, the labelled documents it
sees, chosen by a hash of their id. Features are words and stems (their first four or five
letters); all whose share of toxic documents exceeds that of harmless ones clearly are taken. The fit
runs in one task on the features' numbers. Scores read every word of every text.

Cases: a null or empty text has no sentence and scores the leak. A null ``doc_id`` is held
out. Of several labels of a document the largest counts; null labels are no labels. Without
any labelled document all scores are 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import flush, held_out, rows_of, stage, texts

MAX_FIT = 20_000
MIN_DOCS = 3  # a feature occurs in so many labelled documents at least
MIN_ERRORS = 3.0  # standard errors between its shares of toxic and of harmless documents
BIAS = -9.0
THRESHOLD = 0.3

_SENTENCE_END = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


class Model(NamedTuple):
    weights: dict[str, float]
    leak: float


def marks(text: str) -> set[str]:
    """The features of a text in lower case: its words, and the first four and five letters of
    each, as inflected and compounded words share a stem."""
    words = set(_WORD.findall(text))
    return words | {w[:4] + "-" for w in words} | {w[:5] + "-" for w in words}


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE_END.split(text) if s.strip()]


def word_counts(labelled: DataFrame) -> DataFrame:
    """``(word, toxic, clean)``: in how many documents of each label a word occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for data, toxic in rows_of(batches, "data", "toxic"):
            found[toxic == 1].update(marks(data.decode("utf-8", "replace").lower()))
        words = list(found[True].keys() | found[False].keys())
        columns = [words, [found[True][w] for w in words], [found[False][w] for w in words]]
        for i in range(0, len(words), 50_000):
            yield pa.record_batch([pa.array(c[i : i + 50_000], t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["word", "toxic", "clean"])

    return labelled.mapInArrow(count, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def features(counts: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Log-odds of the features that speak for toxicity by ``MIN_ERRORS`` standard errors or more."""
    a, b = (F.col("toxic") + 0.5) / (n_toxic + 1), (F.col("clean") + 0.5) / (n_clean + 1)
    error = F.sqrt(a * (1 - a) / (n_toxic + 1) + b * (1 - b) / (n_clean + 1))
    ranked = counts.where(F.col("toxic") + F.col("clean") >= MIN_DOCS).select("word", F.log(a / b).alias("odds"), ((a - b) / error).alias("z")).where(F.col("z") >= MIN_ERRORS)
    return {r.word: r.odds for r in ranked.orderBy(F.desc("z"), "word").collect()}


def bag_rows(labelled: DataFrame, index: dict[str, int]) -> DataFrame:
    """Each document as numbers: the features of every sentence that has some."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("words", pa.list_(pa.list_(pa.int32())))])
        rows: list[tuple] = []
        for doc_id, toxic, data in rows_of(batches, "doc_id", "toxic", "data"):
            found = [[index[w] for w in marks(s) if w in index] for s in sentences(data.decode("utf-8", "replace").lower())]
            rows.append((doc_id, toxic, [f for f in found if f]))
            if len(rows) >= 2000:
                yield flush(schema, rows)
        yield flush(schema, rows)

    return labelled.mapInArrow(make, "doc_id long, toxic int, words array<array<int>>")


def fit(bags: pd.DataFrame, start: np.ndarray, steps: int = 300, rate: float = 0.05, ridge: float = 3e-5) -> np.ndarray:
    """Maximum likelihood by Adam over all bags: the weights, then the leak's logit."""
    label = bags["toxic"].to_numpy(np.float64)
    owner, sentence, word = [], [], []
    n = 0
    for d, found in enumerate(bags["words"]):
        for words in found:
            owner.append(d)
            sentence.extend([n] * len(words))
            word.extend(words)
            n += 1
    owner, sentence, word = np.array(owner, int), np.array(sentence, int), np.array(word, int)
    k = len(start)
    theta = np.append(start, -3.0)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, leak = theta[:k], theta[k]
        logit = BIAS + np.bincount(sentence, w[word], minlength=n)
        p, pl = (1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in (logit, leak))
        # log of the chance that nothing in the document offends
        calm = -np.bincount(owner, np.logaddexp(0, logit), minlength=len(label)) - np.logaddexp(0, leak)
        q = np.exp(np.minimum(calm, -1e-9))
        slope = np.where(label == 1, q / np.maximum(1 - q, 1e-9), -1.0)  # of the log-likelihood by -calm
        g = np.append(np.bincount(word, (slope[owner] * p)[sentence], minlength=k), slope.sum() * pl) / len(label)
        g[:k] -= ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return theta


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """The model of ``MAX_FIT`` labelled documents that are not held out."""
    own = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where("toxic is not null and doc_id is not null")
    own = own.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # At most MAX_FIT pairs of numbers, hence the broadcast: the texts stay where they are read.
    sample = F.broadcast(own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_FIT))
    labelled = stage(texts(docs, id_col, text_col).join(sample, "doc_id"), "labelled")
    sizes = {r.toxic: r["count"] for r in labelled.groupBy((F.col("toxic") == 1).cast("int").alias("toxic")).count().collect()}
    if not sizes:
        return None
    odds = features(word_counts(labelled), sizes.get(1, 0), sizes.get(0, 0))
    words = list(odds)
    start = np.array([odds[w] for w in words])
    bags = bag_rows(labelled, {w: i for i, w in enumerate(words)})

    def run(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"theta": [fit(part, start).tolist()]})

    theta = bags.groupBy().applyInPandas(run, "theta array<double>").first().theta
    return Model(dict(zip(words, theta, strict=False)), 1 / (1 + math.exp(-theta[-1])))


def score_sentences(text: str, model: Model) -> tuple[float, list[tuple[int, float, str]]]:
    """The document's score, and each sentence with a feature: its number, score and text."""
    calm, found, get = 1 - model.leak, [], model.weights.get
    for i, s in enumerate(sentences(text)):
        hits = [w for w in map(get, marks(s.lower())) if w is not None]
        if hits:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, BIAS + sum(hits)))))
            found.append((i, p, s))
            calm *= 1 - p
    return 1 - calm, found


def score_column(text: Column, model: Model | None) -> Column:
    """The score of each row's text, for filters that need no identifier."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: score_sentences(t, model)[0] if model else 0.0)

    return run(F.coalesce(text.cast("string"), F.lit("")))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, offending)``: ``offending`` has number, score and text of every sentence
    that alone reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.struct([("sentence", pa.int32()), ("score", pa.float64()), ("text", pa.string())])
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("offending", pa.list_(part))])
        rows: list[tuple] = []
        for doc_id, data in rows_of(batches, "doc_id", "data"):
            p, found = score_sentences(data.decode("utf-8", "replace"), model) if model else (0.0, [])
            rows.append((doc_id, min(1.0, max(0.0, p)), [{"sentence": i, "score": q, "text": s} for i, q, s in found if q >= threshold]))
            if len(rows) >= 2000:
                yield flush(schema, rows)
        yield flush(schema, rows)

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, offending array<struct<sentence:int,score:double,text:string>>")
