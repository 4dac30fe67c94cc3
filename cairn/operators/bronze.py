"""Bronze layer: typed projections of the raw activity records.

Every bronze table is a projection of one keyed relation, the *records*
(raw activity with ``id`` renamed ``activity_id`` and struct fields lifted).
``bronze_activities`` is the keyed, append-only history (see
``cairn.operators.ingest``); the side tables follow it key for key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.schemas import BRONZE_ACTIVITIES, ORDER_COLS

# Columns of each published bronze table, as named in the records.
TABLE_COLUMNS = {
    "bronze_activities": BRONZE_ACTIVITIES.names,
    "bronze_heartrate": [
        "activity_id",
        "has_heartrate",
        "average_heartrate",
        "max_heartrate",
        "heartrate_opt_out",
        "display_hide_heartrate_option",
    ],
    "bronze_metrics": [
        "activity_id",
        "distance",
        "moving_time",
        "elapsed_time",
        "total_elevation_gain",
        "average_speed",
        "max_speed",
        "elev_high",
        "elev_low",
    ],
    "bronze_engagement": [
        "activity_id",
        "achievement_count",
        "kudos_count",
        "comment_count",
        "athlete_count",
        "photo_count",
        "total_photo_count",
        "pr_count",
    ],
    "bronze_location": ["activity_id", "location_city", "location_state", "location_country"],
    # struct field access: map.id, map.summary_polyline, map.resource_state
    "bronze_map": ["activity_id", "map_id", "summary_polyline", "map_resource_state AS resource_state"],
    # array columns carried through untouched
    "bronze_geo": ["activity_id", "start_latlng", "end_latlng"],
}


def records(raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """All bronze columns in one relation keyed by ``activity_id``, and the
    ``order`` columns of records that are not merged yet."""
    lifted = {"id", "athlete", "map", *ORDER_COLS} - set(order)
    return raw.select(
        F.col("id").alias("activity_id"),
        F.col("athlete.id").alias("athlete_id"),
        *[c for c in raw.columns if c not in lifted],
        F.col("map.id").alias("map_id"),
        F.col("map.summary_polyline").alias("summary_polyline"),
        F.col("map.resource_state").alias("map_resource_state"),
    )


def _typed() -> list[str]:
    return [f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in BRONZE_ACTIVITIES.fields]


def project(recs: DataFrame, name: str) -> DataFrame:
    """One published bronze table from the records."""
    if name == "bronze_activities":  # the typed first-run definition
        return recs.selectExpr(*_typed())
    return recs.selectExpr(*TABLE_COLUMNS[name])


def activities(raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """raw activity records -> ``bronze_activities`` (23 typed columns), and the
    ``order`` columns."""
    recs = records(raw, order)
    return project(recs, "bronze_activities") if not order else recs.selectExpr(*_typed(), *order)
