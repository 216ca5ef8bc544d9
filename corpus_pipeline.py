"""A corpus pipeline from ``documents`` to packed training sequences; part of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import AbstractContextManager
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import decontaminate, language, neardup, packing, quality
from tradewind.llm.queries import table
from tradewind.session import scratch, settings, shared_folder, stored

LEAST_QUALITY = 0.5
LEAST_CERTAINTY = 0.5
AT_ONCE = 1000  # documents, of some KB each, that a task hands to Python at once
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def small_batches(spark: SparkSession) -> AbstractContextManager:
    """Inside, few documents are in memory at once.

    Spark and the worker both hold a batch of whole texts, and Python's side some copies of it. All documents
    are read in any case; Spark's 10,000 rows (if the session has no fewer) are only cut into smaller batches.
    """
    rows = int(spark.conf.get(BATCH_ROWS))
    return settings(spark, {BATCH_ROWS: min(rows, AT_ONCE) if rows > 0 else AT_ONCE})


def in_small_batches(stage: Stage) -> Stage:
    """The stage run to its end in small batches: its result, stored, and nothing else that it stored on its way."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        folder = shared_folder(spark)
        with small_batches(spark), scratch(spark):
            return stored(stage(spark, docs, sf_dir), folder)

    return run


def decided_in_small_batches(stage: Stage) -> Stage:
    """A stage that stores which rows it keeps, in small batches, and returns these of ``docs`` without any Python:
    they need no copy."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark):
            return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose passages look good; learned from the labels of the documents at hand.

    A NULL or empty text is one empty passage and scored like any other; without labels of both
    classes the smoothed share of good labels decides, which without any label is 0.5: everything stays.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", folds=4, fold=2)
    return quality.predict(docs, model).where(f"score >= {LEAST_QUALITY}").select(*docs.columns)


@in_small_batches
def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; the score is near 1 for any longer text, so hardly another one goes."""
    model = language.fit(docs)
    found = language.predict(docs, model)
    return found.where(f"lang_pred <> '{language.UNKNOWN}' AND score >= {LEAST_CERTAINTY}").select(*docs.columns)


@decided_in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are similar by 0.8 or more."""
    return neardup.one_of_each(docs, neardup.Settings(shingle=5, percent=80)).select(*docs.columns)


@in_small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in whatever order its passages come."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


@in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 4096 tokens."""
    parts = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return packing.pack(stored(parts))


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # trained models, sketches and tokenizers are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``. What they store for one another is removed at the end."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    with scratch(spark):
        for _, stage in STAGES:
            docs = stage(spark, docs, sf_dir)
        return stored(docs, folder)
