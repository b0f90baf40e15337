"""Documents to a training mixture, in stages that each read what the one before has written.

Every stage takes ``(spark, docs, sf_dir)`` and judges exactly the rows of ``docs``. All but
the last return the columns of ``documents``. Rows are told apart by id and text: an id that is
there with two texts is two documents, and rows without an id are judged like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.llm import exact_dedup, fm_index, mixing, simhash, toxicity
from docmart.llm.common import stage, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learnt from the labels of ``docs``, calls toxic go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(F.col("text"), model) < toxicity.THRESHOLD)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest ``doc_id`` stays."""
    return exact_dedup.keep_one(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints of four-word shingles are linked, at four differing bits or
    fewer, the one with the smallest ``doc_id`` stays."""
    return simhash.keep_one(docs, words_each=4, distance=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a phrase of ``benchmark`` go."""
    return fm_index.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: one row per placement of a document, in the order of ``(pass, block_order,
    source, block, doc_order)``; documents beyond their source's budget have none."""
    return mixing.mix(mixing.token_counts(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# The first stage is a fitted classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
