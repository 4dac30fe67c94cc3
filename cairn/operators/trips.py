"""The five trip-benchmark queries over a trip relation.

Each is one scan + filter + hash aggregate (partial aggregation before the
shuffle, so at most one row per group per task is exchanged) and, for the
top-k, a ``TakeOrderedAndProject``. Filters reference stored columns only,
so they reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions import round_half_away_sql

# Payment type code -> method name (anything else is 'Unknown').
PAYMENT_METHODS = [(1, "Credit Card"), (2, "Cash"), (3, "No Charge"), (4, "Dispute")]
UNKNOWN_METHOD = "Unknown"


def _count(name: str = "trips"):
    return F.expr(f"count(1) AS {name}")


def _rounded(value: str, name: str):
    """A rounded aggregate, as one SQL expression (a column built call by call
    costs dozens of driver round trips a query)."""
    return F.expr(f"{round_half_away_sql(value, 2)} AS {name}")


def row_count(trips: DataFrame) -> DataFrame:
    return trips.agg(_count("total_trips"))


def revenue_by_month(trips: DataFrame) -> DataFrame:
    return (
        trips.where("total_amount > 0")
        .groupBy(F.expr("month(tpep_pickup_datetime) AS month"))
        .agg(_count(), _rounded("sum(total_amount)", "total_revenue"), _rounded("avg(total_amount)", "avg_fare"))
        .orderBy(F.asc_nulls_last("month"))
    )


def busiest_hours(trips: DataFrame, k: int = 5) -> DataFrame:
    return (
        trips.groupBy(F.expr("hour(tpep_pickup_datetime) AS hour_of_day"))
        .agg(_count(), _rounded("avg(trip_distance)", "avg_distance_miles"))
        .orderBy(F.desc_nulls_last("trips"), F.asc_nulls_last("hour_of_day"))
        .limit(k)
    )


def tip_analysis(trips: DataFrame) -> DataFrame:
    share = "avg(tip_amount / nullif(fare_amount, 0) * 100.0D)"
    return (
        trips.where("fare_amount > 0 AND passenger_count > 0")
        .groupBy("passenger_count")
        .agg(_count(), _rounded("avg(tip_amount)", "avg_tip"), _rounded(share, "avg_tip_pct"))
        .orderBy(F.asc_nulls_last("passenger_count"))
    )


def payment_types(trips: DataFrame) -> DataFrame:
    cases = " ".join(f"WHEN {code} THEN '{name}'" for code, name in PAYMENT_METHODS)
    return (
        trips.groupBy(F.expr(f"CASE payment_type {cases} ELSE '{UNKNOWN_METHOD}' END AS payment_method"))
        .agg(_count(), _rounded("sum(total_amount)", "total_revenue"))
        .orderBy(F.desc_nulls_last("trips"), F.asc_nulls_last("payment_method"))
    )
