"""Gold layer: summaries over ``silver_activity_fact``.

Rollups are hash aggregates with a partial (map-side) step, so only one row
per (partition, period) crosses the shuffle whatever the skew of the data.
Double SUM/AVG are plain floating-point aggregates, as in the reference
engine: the last bits depend on the order partial sums meet (an exact
DECIMAL(38,18) sum measured ~2.5x slower, so it is not used).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions import trunc_ntz


def activity_summary(fact: DataFrame) -> DataFrame:
    return fact.select(
        "activity_id",
        "name",
        "sport_type",
        "start_date_utc",
        "distance_km",
        "moving_time_min",
        "pace_min_per_km",
        "total_elevation_m",
        "average_heartrate",
        "max_heartrate",
        "kudos_count",
        "comment_count",
        "pr_count",
        "trainer",
        "commute",
        trunc_ntz("week", "start_date_utc").alias("week_start"),
        trunc_ntz("month", "start_date_utc").alias("month_start"),
    )


def _period_stats(fact: DataFrame, unit: str, label: str, with_comments: bool) -> DataFrame:
    aggs = [
        F.count(F.lit(1)).alias("activity_count"),
        F.sum("distance_km").alias("total_distance_km"),
        F.sum("moving_time_min").alias("total_time_min"),
        F.avg("pace_min_per_km").alias("avg_pace"),
        F.min("pace_min_per_km").alias("best_pace"),
        F.avg("average_heartrate").alias("avg_heartrate"),
        F.max("max_heartrate").alias("max_heartrate"),
        F.sum("total_elevation_m").alias("total_elevation_m"),
        F.sum("kudos_count").alias("total_kudos"),
    ]
    if with_comments:
        aggs.append(F.sum("comment_count").alias("total_comments"))
    aggs.append(F.sum("pr_count").alias("total_prs"))
    return (
        fact.groupBy(trunc_ntz(unit, "start_date_utc").alias(label))
        .agg(*aggs)
        .orderBy(F.asc_nulls_last(label))
    )


PERIODS = {
    "gold_weekly_stats": ("week", "week_start", True),
    "gold_monthly_stats": ("month", "month_start", False),
}


def period_stats(fact: DataFrame, table: str) -> DataFrame:
    unit, label, with_comments = PERIODS[table]
    return _period_stats(fact, unit, label, with_comments)


# Mergeable state of a period: how each part is made from the fact's rows and from
# the parts of other states. Averages are kept as a sum and a count.
_SUMS = ("distance_km", "moving_time_min", "total_elevation_m", "kudos_count", "comment_count", "pr_count")
_MEANS = ("pace_min_per_km", "average_heartrate")


def period_state(fact: DataFrame, table: str) -> DataFrame:
    """One row a period of ``fact``: what its statistics can be merged from."""
    unit, label, _ = PERIODS[table]
    return fact.groupBy(trunc_ntz(unit, "start_date_utc").alias(label)).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(f"sum_{c}") for c in (*_SUMS, *_MEANS)],
        *[F.count(c).alias(f"n_{c}") for c in _MEANS],
        F.min("pace_min_per_km").alias("min_pace_min_per_km"),
        F.max("max_heartrate").alias("max_max_heartrate"),
    )


def period_stats_from_states(states: DataFrame, table: str) -> DataFrame:
    """The rollup of everything the states were made from (any number a period)."""
    _, label, with_comments = PERIODS[table]
    merged = states.groupBy(label).agg(
        F.sum("n").alias("n"),
        *[F.sum(c).alias(c) for c in states.columns if c.startswith(("sum_", "n_"))],
        F.min("min_pace_min_per_km").alias("best_pace"),
        F.max("max_max_heartrate").alias("max_heartrate"),
    )
    mean = lambda c: F.expr(f"CASE WHEN n_{c} > 0 THEN sum_{c} / n_{c} END")
    return merged.select(
        label,
        F.col("n").alias("activity_count"),
        F.col("sum_distance_km").alias("total_distance_km"),
        F.col("sum_moving_time_min").alias("total_time_min"),
        mean("pace_min_per_km").alias("avg_pace"),
        "best_pace",
        mean("average_heartrate").alias("avg_heartrate"),
        "max_heartrate",
        F.col("sum_total_elevation_m").alias("total_elevation_m"),
        F.col("sum_kudos_count").alias("total_kudos"),
        *([F.col("sum_comment_count").alias("total_comments")] if with_comments else []),
        F.col("sum_pr_count").alias("total_prs"),
    ).orderBy(F.asc_nulls_last(label))


def weekly_stats(fact: DataFrame) -> DataFrame:
    return _period_stats(fact, "week", "week_start", with_comments=True)


def monthly_stats(fact: DataFrame) -> DataFrame:
    """Same as weekly, without ``total_comments`` (as in the reference)."""
    return _period_stats(fact, "month", "month_start", with_comments=False)


def pb_efforts(fact: DataFrame, k: int = 10) -> DataFrame:
    """The k fastest paces. NULL paces sort last; ties break on the key.

    ``orderBy + limit`` plans as ``TakeOrderedAndProject``: each partition
    keeps its own top k and only k rows per partition reach the final merge.
    """
    return fact.orderBy(F.asc_nulls_last("pace_min_per_km"), F.asc("activity_id")).limit(k)


def training_load(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("average_heartrate").isNotNull()).select(
        "activity_id",
        "start_date_utc",
        "distance_km",
        "moving_time_min",
        "average_heartrate",
        (F.col("moving_time_min") * F.col("average_heartrate")).alias("effort_score"),
    )


def monthly_by_distance(monthly: DataFrame) -> DataFrame:
    """Ad-hoc read of the monthly table, longest months first."""
    return monthly.orderBy(F.desc_nulls_last("total_distance_km"), F.asc_nulls_last("month_start"))
