"""Silver layer: typed, unit-converted, joined on ``activity_id``.

All joins are LEFT equi-joins on the one key, so Spark shuffles each input
once by ``activity_id`` and the join chain reuses that partitioning; AQE
turns a join into a broadcast only when the runtime size of a side is under
``spark.sql.autoBroadcastJoinThreshold``. Keys are unique per table, so no
join key can be hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def _activity_columns(a: str, m: str) -> list[str]:
    """The 25 ``silver_activities`` columns as SQL expressions, reading
    activity fields from alias ``a`` and metric fields from alias ``m``.
    Literals are DOUBLE (``60.0D``): a bare ``60.0`` is a DECIMAL in Spark."""
    km = f"({m}.distance / 1000.0D)"
    minutes = f"({m}.moving_time / 60.0D)"
    return [
        f"{a}.activity_id AS activity_id",
        f"{a}.name AS name",
        f"{km} AS distance_km",
        f"{minutes} AS moving_time_min",
        f"{m}.elapsed_time / 60.0D AS elapsed_time_min",
        # pace: NULL when the distance is zero, negative or NULL
        f"CASE WHEN {km} > 0 THEN {minutes} / {km} END AS pace_min_per_km",
        f"{m}.total_elevation_gain AS total_elevation_m",
        *[f"{m}.{c} AS {c}" for c in ("average_speed", "max_speed", "elev_high", "elev_low")],
        *[f"{a}.{c} AS {c}" for c in ("type", "sport_type", "workout_type", "device_name")],
        # text -> timestamp without zone (an offset suffix is dropped, not applied)
        f"CAST({a}.start_date AS TIMESTAMP_NTZ) AS start_date_utc",
        f"CAST({a}.start_date_local AS TIMESTAMP_NTZ) AS start_date_local",
        *[
            f"{a}.{c} AS {c}"
            for c in ("timezone", "trainer", "commute", "manual", "private", "visibility", "flagged", "gear_id")
        ],
    ]


FACT_EXTRA_COLUMNS = (
    "kudos_count",
    "comment_count",
    "achievement_count",
    "pr_count",
    "location_city",
    "location_state",
    "location_country",
)


def activities(bronze_activities: DataFrame, bronze_metrics: DataFrame) -> DataFrame:
    """bronze_activities LEFT JOIN bronze_metrics on the key."""
    a = bronze_activities.where(F.col("activity_id").isNotNull()).alias("a")
    m = bronze_metrics.alias("m")
    return a.join(m, F.col("a.activity_id") == F.col("m.activity_id"), "left").selectExpr(*_activity_columns("a", "m"))


def activities_from_records(records: DataFrame) -> DataFrame:
    """``silver_activities`` as one projection of the keyed bronze records
    (see ``activity_fact_from_records`` for when this equals the join)."""
    r = records.where(F.col("activity_id").isNotNull()).alias("r")
    return r.selectExpr(*_activity_columns("r", "r"))


def heartrate(bronze_heartrate: DataFrame) -> DataFrame:
    flag = F.col("has_heartrate")
    return bronze_heartrate.where(F.col("activity_id").isNotNull()).select(
        "activity_id",
        F.when(flag, F.col("average_heartrate")).alias("average_heartrate"),
        F.when(flag, F.col("max_heartrate")).alias("max_heartrate"),
        "has_heartrate",
    )


def engagement(bronze_engagement: DataFrame) -> DataFrame:
    return bronze_engagement.where(F.col("activity_id").isNotNull()).select(
        "activity_id",
        "achievement_count",
        "kudos_count",
        "comment_count",
        "athlete_count",
        "photo_count",
        "total_photo_count",
        "pr_count",
    )


def location(bronze_location: DataFrame) -> DataFrame:
    return bronze_location.where(F.col("activity_id").isNotNull()).select(
        "activity_id", "location_city", "location_state", "location_country"
    )


def activity_fact(
    activities_: DataFrame, heartrate_: DataFrame, engagement_: DataFrame, location_: DataFrame
) -> DataFrame:
    """``a.*`` plus heart rate, engagement and location, all LEFT joined on the key."""
    h = heartrate_.select("activity_id", "average_heartrate", "max_heartrate", "has_heartrate")
    e = engagement_.select("activity_id", "kudos_count", "comment_count", "achievement_count", "pr_count")
    loc = location_.select("activity_id", "location_city", "location_state", "location_country")
    return activities_.join(h, "activity_id", "left").join(e, "activity_id", "left").join(loc, "activity_id", "left")


def activity_fact_from_records(records: DataFrame, owner: bool = False) -> DataFrame:
    """``silver_activity_fact`` when every bronze table is a projection of one
    relation keyed by ``activity_id`` (unique, as bronze guarantees).

    Then each LEFT JOIN of the general form matches exactly the row it came
    from, so the fact is a single projection: one scan, no join, no shuffle.
    Equal to ``activity_fact(activities(...), ...)`` under that invariant
    (a test checks both forms against each other). With ``owner`` the fact
    also carries ``athlete_id``, so the star schema needs no join for it.
    """
    r = records.where(F.col("activity_id").isNotNull()).alias("r")
    return r.selectExpr(
        *_activity_columns("r", "r"),
        "CASE WHEN r.has_heartrate THEN r.average_heartrate END AS average_heartrate",
        "CASE WHEN r.has_heartrate THEN r.max_heartrate END AS max_heartrate",
        "r.has_heartrate AS has_heartrate",
        *[f"r.{c} AS {c}" for c in FACT_EXTRA_COLUMNS],
        *(["r.athlete_id AS athlete_id"] if owner else []),
    )
