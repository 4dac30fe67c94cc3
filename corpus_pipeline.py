"""Corpus pipeline: quality rules, toxicity, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. The first three
return rows of ``documents`` with all their columns; the last returns the pieces
of the packed sequences. Models learn from the labelled rows among the stage's
own input. A stage without labels of both classes has no model: the quality
stage then keeps what passes the rules, the toxicity stage everything, and a
warning says so; labels of which none is of a document at hand are an error.
Nulls, empty texts, repeated rows and ties are as each operator states; columns
of any name pass unchanged through all stages but the last. Tested against brute force (no SQL can express the models).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from cairn.llm import packing, pathjoin, quality, toxicity
from cairn.llm.common import prepare, table, written

log = logging.getLogger(__name__)


def _known(label: str, fit, docs: DataFrame, labels: DataFrame):
    model = fit(docs, labels)
    if model is None:
        quality.labels_fit(docs, labels, label)
        log.warning("no model of %s: its labels are not of both classes here", label)
    return model


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the quality model."""
    return quality.keep_good(docs, _known("quality", quality.fit, docs, table(spark, sf_dir, "labels")))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    return toxicity.keep_clean(docs, _known("toxic", toxicity.fit, docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return pathjoin.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
