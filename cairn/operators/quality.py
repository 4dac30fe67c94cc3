"""Layer validation, primary-key and publish-completeness checks."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def layer_counts(pairs: Sequence[tuple[str, DataFrame, str, DataFrame]]) -> DataFrame:
    """(source, target, source_rows, target_rows) for each layer hop.

    Each count is a global aggregate (partial counts per task, one final
    row); the result is a handful of rows, never the data itself.
    """

    rows = [
        src.agg(
            F.lit(src_name).alias("source"),
            F.lit(tgt_name).alias("target"),
            F.count(F.lit(1)).alias("source_rows"),
            # the target's count enters as a scalar subquery: one plan, no join
            tgt.agg(F.count(F.lit(1))).scalar().alias("target_rows"),
        )
        for src_name, src, tgt_name, tgt in pairs
    ]
    return reduce(DataFrame.unionByName, rows)


def validate_counts(counts: DataFrame, equal: bool = False) -> list[tuple[str, str, int, int]]:
    """Log each hop and raise if a target is empty, or, with ``equal``, if it
    doesn't have as many rows as its source (stops the pipeline)."""
    result = [(r.source, r.target, r.source_rows, r.target_rows) for r in counts.collect()]
    for src, tgt, n_src, n_tgt in result:
        log.info("%-30s -> %-30s  %d -> %d rows", src, tgt, n_src, n_tgt)
        if n_tgt == 0:
            raise ValueError(f"{tgt} has 0 rows — aborting pipeline")
        if equal and n_src != n_tgt:
            raise ValueError(f"{tgt} has {n_tgt} rows, {src} has {n_src} — aborting pipeline")
    return result


def assert_unique(table: DataFrame, key: str) -> None:
    """Raise if ``key`` repeats (the first-run table declares it primary)."""
    dup = table.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {key}={dup[0][key]!r}")


def assert_new_and_unique(rows: DataFrame, history: DataFrame | None, key: str) -> None:
    """Raise if a key of ``rows`` is null, repeats, or is in ``history`` (which
    the caller limits to what can hold one)."""
    if not rows.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"null key {key}")
    assert_unique(rows, key)
    if history is not None:
        known = rows.join(history.select(key), key, "left_semi").limit(1).collect()
        if known:
            raise ValueError(f"duplicate key {key}={known[0][key]!r}: in the table already")


def written_counts(spark: SparkSession, lake, hops: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Like :func:`layer_counts`, for tables of a lake, each hop (layer, source,
    layer, target): the rows each write counted, added up. Reads no data."""
    rows = [(a, b, lake.rows(of_a, a), lake.rows(of_b, b)) for of_a, a, of_b, b in hops]
    return spark.createDataFrame(rows, "source string, target string, source_rows long, target_rows long")


def missing_tables(spark: SparkSession, listing: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected table names that the catalog listing does not show."""
    want = spark.createDataFrame([(n,) for n in expected], "table_name string")
    return want.join(listing.select("table_name"), "table_name", "left_anti")
