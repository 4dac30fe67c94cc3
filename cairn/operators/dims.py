"""Star schema: date, activity type and athlete dimensions plus the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions import case_map, date_part, day_name, month_name, round_half_away_sql, trunc_date

# Sport type -> category (anything else is 'Other').
SPORT_CATEGORIES = [
    ("Run", "Cardio"),
    ("Ride", "Cardio"),
    ("Swim", "Cardio"),
    ("WeightTraining", "Strength"),
    ("Yoga", "Flexibility"),
]
OTHER_CATEGORY = "Other"

# Heart-rate zone upper bounds (exclusive) and labels.
HR_ZONES = [
    (120, "Zone 1 — Easy"),
    (140, "Zone 2 — Aerobic"),
    (160, "Zone 3 — Tempo"),
    (175, "Zone 4 — Threshold"),
]
TOP_ZONE = "Zone 5 — Max"

KM_TO_MILES = 0.621371
M_TO_FEET = 3.28084


def date_dim(fact: DataFrame) -> DataFrame:
    """One row per distinct start day (a NULL start date gives a NULL row)."""
    ts = F.col("start_date_utc")
    return fact.select(
        trunc_date("day", ts).alias("date_id"),
        date_part("year", ts).alias("year"),
        date_part("month", ts).alias("month"),
        date_part("day", ts).alias("day"),
        day_name(ts).alias("day_name"),
        month_name(ts).alias("month_name"),
        date_part("week", ts).alias("week_number"),
        date_part("quarter", ts).alias("quarter"),
        trunc_date("week", ts).alias("week_start"),
        trunc_date("month", ts).alias("month_start"),
    ).distinct()


def _with_owner(fact: DataFrame, bronze_activities: DataFrame | None) -> DataFrame:
    """The fact with its owner id: carried along where the fact holds it, else a
    LEFT join back to bronze (unique key on both sides)."""
    if "athlete_id" in fact.columns:
        return fact
    owners = bronze_activities.select("activity_id", "athlete_id")
    return fact.join(owners, "activity_id", "left")


def _narrow(fact: DataFrame, *cols: str) -> DataFrame:
    return fact.select(*cols, *(["athlete_id"] if "athlete_id" in fact.columns else []))


def activity_type_dim(fact: DataFrame, bronze_activities: DataFrame | None) -> DataFrame:
    """Distinct (athlete, sport type): the type id is unique per athlete only."""
    sport = F.col("sport_type")
    return (
        _with_owner(_narrow(fact.where(sport.isNotNull()), "activity_id", "sport_type"), bronze_activities)
        .select(
            "athlete_id",
            sport.alias("activity_type_id"),
            sport.alias("sport_type"),
            case_map(sport, SPORT_CATEGORIES, OTHER_CATEGORY).alias("sport_category"),
        )
        .distinct()
    )


def owner_ids(fact: DataFrame, bronze_activities: DataFrame | None) -> DataFrame:
    """Distinct owners of the fact's activities (partial aggregation first)."""
    return _with_owner(_narrow(fact, "activity_id"), bronze_activities).select("athlete_id").distinct()


def name_owners(owners: DataFrame, athletes: DataFrame) -> DataFrame:
    """Display names. An athlete with several records has one name (the greatest
    first and last name, NULLs least); two missing names give NULL."""
    parts = F.struct("firstname", "lastname")
    one = athletes.groupBy(F.col("id").alias("athlete_id")).agg(F.max(parts).alias("n"))
    names = one.select("athlete_id", F.nullif(F.concat_ws(" ", "n.firstname", "n.lastname"), F.lit("")).alias("athlete_name"))
    return owners.join(names, "athlete_id", "left").select("athlete_id", "athlete_name")


def athlete_dim(fact: DataFrame, bronze_activities: DataFrame | None, athletes: DataFrame) -> DataFrame:
    """Distinct owners with a display name.

    The reference writes one hard-coded name; here the name comes from the
    athlete records. Owners are reduced to distinct ids first (partial
    aggregation), so the name lookup joins one row per athlete, not per activity.
    """
    return name_owners(owner_ids(fact, bronze_activities), athletes)


def hr_zone_sql(avg_hr: str) -> str:
    """Searched CASE over the zone bounds; NULL falls through to the top zone."""
    whens = " ".join(f"WHEN {avg_hr} < {bound} THEN '{label}'" for bound, label in HR_ZONES)
    return f"CASE {whens} ELSE '{TOP_ZONE}' END"


# Fact columns carried through unchanged.
FACT_PASSTHROUGH = (
    "distance_km",
    "moving_time_min",
    "elapsed_time_min",
    "pace_min_per_km",
    "total_elevation_m",
    "average_heartrate",
    "max_heartrate",
    "average_speed",
    "max_speed",
    "kudos_count",
    "comment_count",
    "achievement_count",
    "pr_count",
    "trainer",
    "commute",
)


def activity_fact(fact: DataFrame, bronze_activities: DataFrame | None) -> DataFrame:
    a = fact.where(F.col("activity_id").isNotNull())
    return _with_owner(a, bronze_activities).selectExpr(
        "activity_id",
        "CAST(start_date_utc AS DATE) AS date_id",
        "sport_type AS activity_type_id",
        "athlete_id",
        "name AS activity_name",
        *FACT_PASSTHROUGH,
        f"{round_half_away_sql(f'distance_km * {KM_TO_MILES}D', 2)} AS distance_miles",
        f"{round_half_away_sql(f'total_elevation_m * {M_TO_FEET}D', 0)} AS elevation_feet",
        f"{hr_zone_sql('average_heartrate')} AS hr_zone",
        "moving_time_min * average_heartrate AS effort_score",
    )


def hr_zone_histogram(fact_activities: DataFrame) -> DataFrame:
    return fact_activities.groupBy("hr_zone").agg(F.count(F.lit(1)).alias("activities"))
