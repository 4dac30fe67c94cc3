"""Plan regressions: the physical plans stay the ones designed for scale."""

import pytest

from cairn.queries import registry
from conftest import SF_SMALL

QUERIES = registry()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_nested_loop_or_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_filters_on_stored_columns_reach_the_scan(spark):
    # the fetch split is a predicate on orders.o_orderdate: Parquet gets it
    plan = _plan(QUERIES["anti_join_new_ids"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(QUERIES["trips_busiest_hours"](spark, SF_SMALL))
    # hour + distance: the line-item scan must not read prices, flags or keys it does not use
    lineitem_scan = [line for line in plan.splitlines() if "lineitem" in line and "ReadSchema" in line or "FileScan parquet [l_" in line]
    assert lineitem_scan and all("l_returnflag" not in line and "l_extendedprice" not in line for line in lineitem_scan)


def test_top_k_is_take_ordered(spark):
    for name in ("gold_pb_efforts", "trips_busiest_hours"):
        assert "TakeOrderedAndProject" in _plan(QUERIES[name](spark, SF_SMALL)), name


def test_anti_join_has_one_plan_and_runs_nothing_early(spark):
    """No job while the query is built, and no exchange of rows to one task."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build only")
    try:
        df = QUERIES["anti_join_new_ids"](spark, SF_SMALL)
        assert not tracker.getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = _plan(df)
    assert "LeftAnti" in plan and "SinglePartition" not in plan and "BroadcastExchange" not in plan


def test_rollups_aggregate_partially_before_the_shuffle(spark):
    for name in ("gold_weekly_stats", "trips_payment_types", "dim_date"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        # a partial HashAggregate below the exchange and a final one above it
        assert plan.count("HashAggregate(") >= 2 and "Exchange hashpartitioning" in plan, name


def test_silver_fact_single_source_has_no_join(spark):
    from cairn.plans.medallion import Layers
    from cairn.sources import fixtures

    plan = _plan(Layers(fixtures.raw_activities(spark, SF_SMALL)).fact)
    assert "Join" not in plan


def test_keyed_merge_reduces_hot_keys_before_the_shuffle(spark):
    """A key holding a third of all rows is cut to one row per task map-side."""
    from pyspark.sql import functions as F

    from cairn.operators import ingest

    n = 3000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("id"),
        F.lit(1).cast("bigint").alias("batch_seq"),
        F.col("id").alias("row_seq"),
        (F.col("id") * 2).alias("v"),
    ).repartition(8)
    merged = ingest.keyed_merge(rows, ["id"])
    plan = _plan(merged)
    assert "partial_max_by" in plan
    hot = merged.where("id = 0").first()
    assert hot.row_seq == max(i for i in range(n) if i % 3 == 0) and hot.v == 2 * hot.row_seq
