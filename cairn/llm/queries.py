"""Registered queries of the operators.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, divergence, hardneg, linededup, oracle, packing, pathjoin, quality, rule_ensemble, topk, toxicity, urlfilter, warc
from .common import fold, prepare, scratch, table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.archive_pages(table(spark, sf_dir, "pages"), path, min_bytes=0)
    return warc.archived_pages(spark, path)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = lambda key: fold(key, 4) == 2
    ensemble = rule_ensemble.fit(docs, table(spark, sf_dir, "labels"), held_out=held_out)
    scored = rule_ensemble.score(docs, ensemble, threshold=0.7)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.rule_frame(spark))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pathjoin.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda key: key % 20 == 0, k=20)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that hold calls as calls; plain conversations as asked and answered
    (see ``chat``: the given ones hold no tool call)."""
    return chat.formatted(*chat.conversations_read(table(spark, sf_dir, "conversations"))).drop("errors")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = lambda key: fold(key, 5) == 0
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"), held_out=held_out)
    scored = toxicity.score(docs, net, threshold=0.5)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table enters in two increments (by a hash of the id), so the second
    passes the filters of the first."""
    docs = table(spark, sf_dir, "documents")
    index = linededup.LineIndex(spark, scratch(spark, "lines"))
    for half in (0, 1):
        index.insert(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == half))
    return index.kept(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings"), lambda key: key % 100 == 0, label)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = {
        "op1_packing": op1_packing,
        "op2_warc": op2_warc,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_url_filters": op4_url_filters,
        "op5_ngram_jaccard": op5_ngram_jaccard,
        "op6_quality_rules": op6_quality_rules,
        "op7_topk": op7_topk,
        "op8_chat_format": op8_chat_format,
        "op9_bpe": op9_bpe,
        "op10_toxicity": op10_toxicity,
        "op11_divergence": op11_divergence,
        "op12_line_dedup": op12_line_dedup,
        "op13_hard_negatives": op13_hard_negatives,
    }

    def prepared(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        return run

    return {name: prepared(fn) for name, fn in plain.items()}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": oracle.WARC, "op4_url_filters": oracle.URLS, "op7_topk": oracle.TOPK, "op11_divergence": oracle.DIVERGENCE, "op12_line_dedup": oracle.LINES, "op13_hard_negatives": oracle.NEGATIVES}
