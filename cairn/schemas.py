"""Explicit schemas for every landing and bronze table.

Inference needs an extra pass and breaks on empty input (an empty JSON array
gives a zero-column frame that Parquet refuses), so every raw read names its
schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, D, B = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.BooleanType()


def _f(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, True)


# One activity record as the activity API returns it (nested athlete and map).
RAW_ACTIVITY = T.StructType(
    [
        _f("id", L),
        _f("athlete", T.StructType([_f("id", L), _f("resource_state", L)])),
        _f("name", S),
        _f("type", S),
        _f("sport_type", S),
        _f("workout_type", I),
        _f("device_name", S),
        _f("start_date", S),
        _f("start_date_local", S),
        _f("timezone", S),
        _f("utc_offset", D),
        _f("distance", D),
        _f("moving_time", L),
        _f("elapsed_time", L),
        _f("total_elevation_gain", D),
        _f("average_speed", D),
        _f("max_speed", D),
        _f("elev_high", D),
        _f("elev_low", D),
        _f("has_heartrate", B),
        _f("average_heartrate", D),
        _f("max_heartrate", D),
        _f("heartrate_opt_out", B),
        _f("display_hide_heartrate_option", B),
        _f("achievement_count", L),
        _f("kudos_count", L),
        _f("comment_count", L),
        _f("athlete_count", L),
        _f("photo_count", L),
        _f("total_photo_count", L),
        _f("pr_count", L),
        _f("location_city", S),
        _f("location_state", S),
        _f("location_country", S),
        _f("map", T.StructType([_f("id", S), _f("summary_polyline", S), _f("resource_state", L)])),
        _f("start_latlng", T.ArrayType(D)),
        _f("end_latlng", T.ArrayType(D)),
        _f("trainer", B),
        _f("commute", B),
        _f("manual", B),
        _f("private", B),
        _f("visibility", S),
        _f("flagged", B),
        _f("gear_id", S),
        _f("upload_id", L),
        _f("upload_id_str", S),
        _f("external_id", S),
        _f("from_accepted_tag", B),
        _f("has_kudoed", B),
        _f("resource_state", L),
    ]
)

# Landing order columns: which fetch (batch) and where in it a record sat.
# "Last write wins" is decided on these, never on Spark's row order.
ORDER_COLS = ["batch_seq", "row_seq"]

# The same of records read from landed files: the fetch, the file's name, where in
# the file the block that a task read begins, and the place among the task's rows.
LANDED_ORDER = ["batch_seq", "file_seq", "block_seq", "row_seq"]

RAW_ACTIVITY_LANDED = T.StructType(list(RAW_ACTIVITY.fields) + [_f("batch_seq", L), _f("row_seq", L)])

# The first-run table definition of bronze_activities; activity_id is the key.
BRONZE_ACTIVITIES = T.StructType(
    [
        _f("activity_id", L),
        _f("athlete_id", L),
        _f("name", S),
        _f("type", S),
        _f("sport_type", S),
        _f("workout_type", I),
        _f("device_name", S),
        _f("start_date", S),
        _f("start_date_local", S),
        _f("timezone", S),
        _f("utc_offset", D),
        _f("trainer", B),
        _f("commute", B),
        _f("manual", B),
        _f("private", B),
        _f("visibility", S),
        _f("flagged", B),
        _f("gear_id", S),
        _f("upload_id", L),
        _f("upload_id_str", S),
        _f("external_id", S),
        _f("from_accepted_tag", B),
        _f("has_kudoed", B),
    ]
)
BRONZE_KEY = "activity_id"

_ATHLETE_REF = T.StructType([_f("firstname", S), _f("lastname", S)])

# Child records as fetched per parent activity (before the parent key is stamped).
RAW_COMMENT = T.StructType(
    [_f("id", L), _f("text", S), _f("created_at", S), _f("athlete", _ATHLETE_REF)]
)
RAW_KUDO = T.StructType([_f("firstname", S), _f("lastname", S), _f("resource_state", L)])

# Landed child records carry their parent's key.
LANDED_COMMENT = T.StructType([*RAW_COMMENT.fields, _f("activity_id", L)])
LANDED_KUDO = T.StructType([_f("activity_id", L), *RAW_KUDO.fields])

# Keyed-merge keys per landing file (separate columns, never a joined string).
MERGE_KEYS = {
    "activities": ["id"],
    "comments": ["id"],
    "kudos": ["activity_id", "firstname", "lastname"],
}

RAW_ATHLETE = T.StructType(
    [_f("id", L), _f("firstname", S), _f("lastname", S), _f("city", S), _f("country", S)]
)

_TOTALS = T.StructType([_f("count", L), _f("distance", D), _f("moving_time", L), _f("elevation_gain", D)])
# The athlete-stats record, one JSON object.
RAW_STATS = T.StructType(
    [_f("athlete_id", L), _f("all_run_totals", _TOTALS), _f("all_ride_totals", _TOTALS), _f("all_swim_totals", _TOTALS)]
)
