"""DuckDB SQL twins of every registered query (the correctness oracle).

Written independently of the Spark code: the fixture derivations of
``cairn.sources.fixtures``, then one relation a layer from which every table
of that layer is a list of columns or measures, over the driver's pre-registered
views (``orders``, ``lineitem``, ``customer``, ...). Sums of integer columns are
cast to BIGINT (DuckDB widens them to HUGEINT).
"""

from __future__ import annotations

RAW_COLUMNS = """
    o_orderkey AS id,
    o_custkey AS athlete_id,
    CAST(1 AS BIGINT) AS athlete_resource_state,
    'Activity ' || CAST(o_orderkey AS VARCHAR) AS name,
    k AS type,
    CASE WHEN o_orderstatus = 'P' AND k = 'Run' THEN 'TrailRun'
         WHEN o_orderstatus = 'P' AND k = 'Ride' THEN 'VirtualRide'
         ELSE k END AS sport_type,
    CASE WHEN k = 'Run' THEN CAST(o_custkey % 4 AS INTEGER) END AS workout_type,
    CASE WHEN o_orderstatus = 'F' THEN 'Garmin Forerunner 255'
         WHEN o_orderstatus = 'O' THEN 'Apple Watch Ultra' END AS device_name,
    strftime(st, '%Y-%m-%dT%H:%M:%SZ') AS start_date,
    strftime(st + to_seconds(CAST(off AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ') AS start_date_local,
    CASE o_custkey % 4 WHEN 0 THEN '(GMT+01:00) Europe/Berlin' WHEN 1 THEN '(GMT+01:00) Europe/Amsterdam'
         WHEN 2 THEN '(GMT+01:00) Europe/Zurich' ELSE '(GMT-05:00) America/New_York' END AS timezone,
    off AS utc_offset,
    dist AS distance,
    mv AS moving_time,
    mv + o_orderkey % 600 AS elapsed_time,
    CASE WHEN k = 'Run' THEN o_totalprice / 4000.0 WHEN k = 'Ride' THEN o_totalprice / 1000.0
         ELSE CAST(0 AS DOUBLE) END AS total_elevation_gain,
    dist / mv AS average_speed,
    dist / mv * CAST(1.5 AS DOUBLE) AS max_speed,
    CASE WHEN k IN ('Run', 'Ride') THEN CAST(200 + o_custkey % 300 AS DOUBLE) END AS elev_high,
    CASE WHEN k IN ('Run', 'Ride') THEN CAST(150 + o_custkey % 50 AS DOUBLE) END AS elev_low,
    o_orderstatus <> 'P' AS has_heartrate,
    CAST(95 + o_custkey % 90 AS DOUBLE) AS average_heartrate,
    CAST(110 + o_custkey % 90 + o_orderkey % 10 AS DOUBLE) AS max_heartrate,
    false AS heartrate_opt_out,
    o_orderstatus <> 'P' AS display_hide_heartrate_option,
    o_orderkey % 4 AS achievement_count,
    (o_custkey + o_orderkey) % 7 + {bump} AS kudos_count,
    o_orderkey % 3 AS comment_count,
    1 + o_orderkey % 2 AS athlete_count,
    CAST(0 AS BIGINT) AS photo_count,
    o_orderkey % 2 AS total_photo_count,
    CASE WHEN k = 'Run' THEN o_orderkey % 3 ELSE CAST(0 AS BIGINT) END AS pr_count,
    CASE o_custkey % 4 WHEN 0 THEN 'Berlin' WHEN 1 THEN 'Amsterdam' WHEN 2 THEN 'Zurich' END AS location_city,
    CAST(NULL AS VARCHAR) AS location_state,
    CASE o_custkey % 4 WHEN 0 THEN 'Germany' WHEN 1 THEN 'Netherlands' WHEN 2 THEN 'Switzerland' END AS location_country,
    'a' || CAST(o_orderkey AS VARCHAR) AS map_id,
    CASE WHEN k IN ('Run', 'Ride') THEN 'poly_' || CAST(o_orderkey AS VARCHAR) ELSE '' END AS map_summary_polyline,
    CAST(2 AS BIGINT) AS map_resource_state,
    CASE WHEN k IN ('Run', 'Ride') THEN [lat, lng] ELSE CAST([] AS DOUBLE[]) END AS start_latlng,
    CASE WHEN k IN ('Run', 'Ride') THEN [lat + 0.01, lng + 0.01] ELSE CAST([] AS DOUBLE[]) END AS end_latlng,
    (o_orderstatus = 'P' AND k = 'Ride') AS trainer,
    (k = 'Ride' AND o_orderkey % 5 = 0) AS commute,
    false AS manual,
    o_custkey % 10 = 0 AS private,
    CASE WHEN o_custkey % 10 = 0 THEN 'only_me' ELSE 'everyone' END AS visibility,
    false AS flagged,
    CASE WHEN k IN ('Run', 'Ride') THEN 'g' || CAST(o_custkey AS VARCHAR) END AS gear_id,
    o_orderkey + 1000000 AS upload_id,
    CAST(o_orderkey + 1000000 AS VARCHAR) AS upload_id_str,
    'garmin_push_' || CAST(o_orderkey AS VARCHAR) AS external_id,
    false AS from_accepted_tag,
    false AS has_kudoed,
    CAST(2 AS BIGINT) AS resource_state"""

RAW_BASE = """
    SELECT *,
        CASE WHEN k = 'Run' THEN o_totalprice / 40.0 WHEN k = 'Ride' THEN o_totalprice / 8.0
             WHEN k = 'Swim' THEN o_totalprice / 400.0 ELSE CAST(0 AS DOUBLE) END AS dist,
        CAST(FLOOR(o_totalprice * CAST(50 + o_custkey % 50 AS DOUBLE) / 5000.0) AS BIGINT) + 300 AS mv,
        o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS st,
        CASE o_custkey % 4 WHEN 3 THEN CAST(-18000 AS DOUBLE) ELSE CAST(3600 AS DOUBLE) END AS off,
        52.0 + (o_custkey % 100) / 100.0 AS lat,
        13.0 + (o_orderkey % 100) / 100.0 AS lng
    FROM (
        SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'Run' WHEN '2-HIGH' THEN 'Ride'
                  WHEN '3-MEDIUM' THEN 'Swim' WHEN '4-NOT SPECIFIED' THEN 'WeightTraining'
                  ELSE 'Yoga' END AS k
        FROM orders {where}
    )"""


def raw(where: str = "", bump: int = 0) -> str:
    """Flat raw activity records (struct fields as columns, arrays kept)."""
    return f"SELECT {RAW_COLUMNS.format(bump=bump)} FROM ({RAW_BASE.format(where=where)})"


FIRST = "WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"
SECOND = "WHERE o_orderdate >= TIMESTAMP '1999-10-01 00:00:00'"
NO_ARRAYS = "EXCLUDE (start_latlng, end_latlng)"

LANDED = f"""
    SELECT *, CAST(1 AS BIGINT) AS batch_seq, id AS row_seq FROM ({raw(FIRST, 0)})
    UNION ALL
    SELECT *, CAST(2 AS BIGINT) AS batch_seq, id AS row_seq FROM ({raw(SECOND, 1)})"""

BRONZE_ACTIVITIES_COLS = """
    id AS activity_id, athlete_id, name, type, sport_type, workout_type, device_name,
    start_date, start_date_local, timezone, utc_offset,
    trainer, commute, manual, private, visibility, flagged,
    gear_id, upload_id, upload_id_str, external_id, from_accepted_tag, has_kudoed"""

BRONZE_SIDE = {
    "bronze_heartrate": "id AS activity_id, has_heartrate, average_heartrate, max_heartrate, heartrate_opt_out, display_hide_heartrate_option",
    "bronze_metrics": "id AS activity_id, distance, moving_time, elapsed_time, total_elevation_gain, average_speed, max_speed, elev_high, elev_low",
    "bronze_engagement": "id AS activity_id, achievement_count, kudos_count, comment_count, athlete_count, photo_count, total_photo_count, pr_count",
    "bronze_location": "id AS activity_id, location_city, location_state, location_country",
    "bronze_map": "id AS activity_id, map_id, map_summary_polyline AS summary_polyline, map_resource_state AS resource_state",
    "bronze_geo": "id AS activity_id, start_latlng, end_latlng",
}

# The columns of each silver table, by their names in ``acts``.
SILVER = {
    "silver_activities": """activity_id name distance_km moving_time_min elapsed_time_min pace_min_per_km total_elevation_m
        average_speed max_speed elev_high elev_low type sport_type workout_type device_name start_date_utc start_date_local
        timezone trainer commute manual private visibility flagged gear_id""".split(),
    "silver_heartrate": "activity_id average_heartrate max_heartrate has_heartrate".split(),
    "silver_engagement": """activity_id achievement_count kudos_count comment_count athlete_count photo_count
        total_photo_count pr_count""".split(),
    "silver_location": "activity_id location_city location_state location_country".split(),
}
SILVER["silver_activity_fact"] = SILVER["silver_activities"] + """average_heartrate max_heartrate has_heartrate kudos_count
    comment_count achievement_count pr_count location_city location_state location_country""".split()

# One relation a layer: every keyed activity with its typed, converted columns.
ACTS = """
    SELECT * REPLACE (
             if(has_heartrate, average_heartrate, NULL) AS average_heartrate,
             if(has_heartrate, max_heartrate, NULL) AS max_heartrate,
             CAST(start_date_local AS TIMESTAMP) AS start_date_local),
           id AS activity_id,
           distance / 1000.0 AS distance_km,
           moving_time / 60.0 AS moving_time_min,
           elapsed_time / 60.0 AS elapsed_time_min,
           if(distance > 0, moving_time / 60.0 / (distance / 1000.0), NULL) AS pace_min_per_km,
           total_elevation_gain AS total_elevation_m,
           CAST(start_date AS TIMESTAMP) AS start_date_utc
    FROM raw_activities WHERE id IS NOT NULL"""


def chain(raw_sql: str) -> str:
    """WITH clause defining raw -> bronze -> silver views for one raw input."""
    parts = [f"raw_activities AS ({raw_sql})", f"bronze_activities AS (SELECT {BRONZE_ACTIVITIES_COLS} FROM raw_activities)"]
    parts += [f"{name} AS (SELECT {cols} FROM raw_activities)" for name, cols in BRONZE_SIDE.items()]
    parts.append(f"acts AS ({ACTS})")
    parts += [f"{name} AS (SELECT {', '.join(cols)} FROM acts)" for name, cols in SILVER.items()]
    return "WITH " + ",\n".join(parts)


ALL = chain(raw())

# The measures of a period, as (name, aggregate, column).
MEASURES = [
    ("total_distance_km", "sum", "distance_km"),
    ("total_time_min", "sum", "moving_time_min"),
    ("avg_pace", "avg", "pace_min_per_km"),
    ("best_pace", "min", "pace_min_per_km"),
    ("avg_heartrate", "avg", "average_heartrate"),
    ("max_heartrate", "max", "max_heartrate"),
    ("total_elevation_m", "sum", "total_elevation_m"),
    ("total_kudos", "sum", "kudos_count"),
    ("total_comments", "sum", "comment_count"),
    ("total_prs", "sum", "pr_count"),
]
# Plain columns of the published tables.
SUMMARY_COLS = """activity_id name sport_type start_date_utc distance_km moving_time_min pace_min_per_km total_elevation_m
    average_heartrate max_heartrate kudos_count comment_count pr_count trainer commute"""
LOAD_COLS = "activity_id start_date_utc distance_km moving_time_min average_heartrate"
FACT_COLS = """distance_km moving_time_min elapsed_time_min pace_min_per_km total_elevation_m average_heartrate max_heartrate
    average_speed max_speed kudos_count comment_count achievement_count pr_count trainer commute"""
DATE_PARTS = {"year": "year", "month": "month", "day": "day", "week": "week_number", "quarter": "quarter"}
# Sport categories; heart-rate zones and their upper bounds.
CATEGORIES = [("Run", "Cardio"), ("Ride", "Cardio"), ("Swim", "Cardio"), ("WeightTraining", "Strength"), ("Yoga", "Flexibility")]
ZONES = [(120, "Zone 1 — Easy"), (140, "Zone 2 — Aerobic"), (160, "Zone 3 — Tempo"), (175, "Zone 4 — Threshold")]
ZONE = "CASE " + " ".join(f"WHEN average_heartrate < {n} THEN '{z}'" for n, z in ZONES) + " ELSE 'Zone 5 — Max' END"
ATHLETE_NAME = "nullif(concat_ws(' ', split_part(c_name, '#', 1), '#' || split_part(c_name, '#', 2)), '')"


def _cols(names: str) -> str:
    return ", ".join(names.split())


def _starts(unit: str, cast: str = "TIMESTAMP") -> str:
    return f"CAST(date_trunc('{unit}', start_date_utc) AS {cast}) AS {unit}_start"


def _period(unit: str, without: str = "") -> str:
    def measure(name, fn, col):
        return f"CAST(sum({col}) AS BIGINT) AS {name}" if col.endswith("_count") else f"{fn}({col}) AS {name}"

    measures = ", ".join(measure(*m) for m in MEASURES if m[0] != without)
    return f"SELECT {_starts(unit)}, count(*) AS activity_count, {measures} FROM acts GROUP BY ALL"


def _case(operand: str, pairs, other: str) -> str:
    whens = " ".join(f"WHEN {operand} = {k!r} THEN '{v}'" for k, v in pairs)
    return f"CASE {whens} ELSE '{other}' END"


GOLD = {
    "gold_activity_summary": f"SELECT {_cols(SUMMARY_COLS)}, {_starts('week')}, {_starts('month')} FROM acts",
    "gold_weekly_stats": _period("week"),
    "gold_monthly_stats": _period("month", without="total_comments"),
    "gold_pb_efforts": """FROM silver_activity_fact
        QUALIFY row_number() OVER (ORDER BY pace_min_per_km NULLS LAST, activity_id) <= 10""",
    "gold_training_load": f"""SELECT {_cols(LOAD_COLS)}, moving_time_min * average_heartrate AS effort_score
        FROM acts WHERE average_heartrate IS NOT NULL""",
}

STAR = {
    "dim_date": f"""SELECT DISTINCT CAST(start_date_utc AS DATE) AS date_id,
        {', '.join(f"date_part('{part}', start_date_utc) AS {name}" for part, name in DATE_PARTS.items())},
        strftime(start_date_utc, '%A') AS day_name, strftime(start_date_utc, '%B') AS month_name,
        {_starts('week', 'DATE')}, {_starts('month', 'DATE')} FROM acts""",
    "dim_activity_type": f"""SELECT athlete_id, sport_type AS activity_type_id, sport_type,
        {_case('sport_type', CATEGORIES, 'Other')} AS sport_category FROM acts WHERE sport_type IS NOT NULL GROUP BY ALL""",
    "dim_athlete": f"""SELECT athlete_id, any_value({ATHLETE_NAME}) AS athlete_name
        FROM acts LEFT JOIN customer ON c_custkey = athlete_id GROUP BY athlete_id""",
    "fact_activities": f"""SELECT activity_id, CAST(start_date_utc AS DATE) AS date_id, sport_type AS activity_type_id, athlete_id,
        name AS activity_name, {_cols(FACT_COLS)}, round(distance_km * 0.621371, 2) AS distance_miles,
        round(total_elevation_m * 3.28084, 0) AS elevation_feet, {ZONE} AS hr_zone,
        moving_time_min * average_heartrate AS effort_score FROM acts""",
}

TRIPS = """
WITH yellow AS (
    SELECT CAST(1 + l_suppkey % 2 AS INTEGER) AS VendorID,
        pu AS tpep_pickup_datetime,
        pu + to_minutes(5 + CAST(FLOOR(l_quantity) AS BIGINT)) AS tpep_dropoff_datetime,
        CAST(l_linenumber - 1 AS BIGINT) AS passenger_count,
        l_quantity / 5.0 AS trip_distance,
        l_partkey % 6 AS payment_type,
        fare AS fare_amount,
        tip AS tip_amount,
        CAST(0.5 AS DOUBLE) AS mta_tax,
        CASE WHEN l_partkey % 6 = 4 THEN -(fare + tip + 0.5) ELSE fare + tip + 0.5 END AS total_amount,
        CASE WHEN l_tax >= 0.07 THEN CAST(1.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS airport_fee
    FROM (SELECT *,
            l_shipdate + to_minutes((l_orderkey * 37 + l_linenumber * 11) % 1440) AS pu,
            CASE WHEN l_discount = 0.0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice / 1000.0 END AS fare,
            l_extendedprice / 1000.0 * l_tax AS tip
          FROM lineitem)
), order_trips AS (
    SELECT o_orderdate + to_minutes((o_orderkey * 53) % 1440) AS tpep_pickup_datetime,
        o_orderdate + to_minutes((o_orderkey * 53) % 1440) + to_minutes(20) AS tpep_dropoff_datetime,
        CAST(2 AS BIGINT) AS VendorID,
        CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS payment_type,
        o_totalprice / 50000.0 AS trip_distance,
        o_totalprice / 10000.0 AS fare_amount,
        CAST(0 AS DOUBLE) AS tip_amount,
        CAST(0.5 AS DOUBLE) AS mta_tax,
        o_totalprice / 10000.0 + 0.5 AS total_amount,
        CAST(0 AS DOUBLE) AS Airport_fee
    FROM orders
), trips AS (
    SELECT * FROM yellow UNION ALL BY NAME SELECT * FROM order_trips
)"""

def _trips(group: str, measures: dict[str, str], where: str = "true", order: str = "", top: str = "") -> str:
    """Trips by one key: their number and rounded measures."""
    rounded = ", ".join(f"round({value}, 2) AS {name}" for name, value in measures.items())
    return f"SELECT {group}, count(*) AS trips, {rounded} FROM trips WHERE {where} GROUP BY ALL ORDER BY {order or group.split(' AS ')[-1]} {top}"


METHODS = [(1, "Credit Card"), (2, "Cash"), (3, "No Charge"), (4, "Dispute")]
TRIP_QUERIES = {
    "trips_row_count": "SELECT count(*) AS total_trips FROM trips",
    "trips_revenue_by_month": _trips(
        "month(tpep_pickup_datetime) AS month", {"total_revenue": "sum(total_amount)", "avg_fare": "avg(total_amount)"}, "total_amount > 0"
    ),
    "trips_busiest_hours": _trips(
        "hour(tpep_pickup_datetime) AS hour_of_day", {"avg_distance_miles": "avg(trip_distance)"}, order="trips DESC, hour_of_day", top="LIMIT 5"
    ),
    "trips_tip_analysis": _trips(
        "passenger_count",
        {"avg_tip": "avg(tip_amount)", "avg_tip_pct": "avg(tip_amount / nullif(fare_amount, 0) * 100)"},
        "fare_amount > 0 AND passenger_count > 0",
    ),
    "trips_payment_types": _trips(
        f"{_case('payment_type', METHODS, 'Unknown')} AS payment_method", {"total_revenue": "sum(total_amount)"}, order="trips DESC, payment_method"
    ),
}


def _children(kind: str) -> str:
    """Comments or kudos generated per parent in the landed fetches."""
    if kind == "comments":
        return f"""
        SELECT id * 10 + k AS id, id AS activity_id,
            'Nice one #' || CAST(k AS VARCHAR) || CASE WHEN batch_seq > 1 THEN ' (edited)' ELSE '' END AS text,
            '2024-01-01T00:00:00Z' AS created_at, 'Fan' AS firstname, 'C' || CAST(k AS VARCHAR) AS lastname,
            batch_seq, id * 1000 + (k - 1) AS row_seq
        FROM (SELECT id, batch_seq, unnest(range(1, comment_count + 1)) AS k
              FROM ({LANDED}) WHERE comment_count > 0 OR kudos_count > 0)"""
    return f"""
        SELECT id AS activity_id, 'Fan' AS firstname, 'K' || CAST((id + k) % 5 AS VARCHAR) AS lastname,
            CAST(2 AS BIGINT) AS resource_state, batch_seq, id * 1000 + (k - 1) AS row_seq
        FROM (SELECT id, batch_seq, unnest(range(1, kudos_count + 1)) AS k
              FROM ({LANDED}) WHERE comment_count > 0 OR kudos_count > 0)"""


def _latest(sql: str, keys: str) -> str:
    return f"""SELECT * FROM ({sql})
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY batch_seq DESC, row_seq DESC) = 1"""


BRONZE_FIRST = f"SELECT {BRONZE_ACTIVITIES_COLS} FROM ({raw(FIRST, 0)})"
BRONZE_SECOND = f"SELECT {BRONZE_ACTIVITIES_COLS} FROM ({raw(SECOND, 1)})"
NEW_IN_SECOND = f"""SELECT * FROM ({BRONZE_SECOND}) WHERE activity_id IS NOT NULL
    AND activity_id NOT IN (SELECT activity_id FROM ({BRONZE_FIRST}) WHERE activity_id IS NOT NULL)"""
BRONZE_ALL = f"SELECT {BRONZE_ACTIVITIES_COLS} FROM ({raw()})"
FIRST_WATERMARK = f"SELECT MAX(start_date::TIMESTAMP) FROM ({raw(FIRST, 0)})"


# What publish_gold shows of each published table (key, measure),
# stated here in this engine's own terms.
PUBLISHED = {
    "gold_activity_summary": ("activity_id", "kudos_count"),
    "gold_weekly_stats": ("strftime(week_start, '%Y-%m-%d')", "activity_count"),
    "gold_monthly_stats": ("strftime(month_start, '%Y-%m-%d')", "activity_count"),
    "gold_pb_efforts": ("activity_id", "pr_count"),
    "gold_training_load": ("activity_id", "average_heartrate::BIGINT"),
    "dim_date": ("date_id", "week_number"),
    "dim_activity_type": ("athlete_id", "sport_category"),
    "dim_athlete": ("athlete_id", "athlete_name"),
    "fact_activities": ("activity_id", "hr_zone"),
}


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    for name in BRONZE_SIDE:
        q[name] = f"{ALL} SELECT * FROM {name}"
    for name in SILVER:
        q[name] = f"{ALL} SELECT * FROM {name}"
    for name, sql in GOLD.items():
        q[name] = f"{ALL} {sql}"
    q["gold_monthly_by_distance"] = (
        f"{ALL}, m AS ({GOLD['gold_monthly_stats']}) SELECT * FROM m ORDER BY total_distance_km DESC NULLS LAST, month_start"
    )
    for name, sql in STAR.items():
        q[name] = f"{ALL} {sql}"
    q["hr_zone_histogram"] = (
        f"{ALL}, f AS ({STAR['fact_activities']}) SELECT hr_zone, COUNT(*) AS activities FROM f GROUP BY 1"
    )
    for name, sql in TRIP_QUERIES.items():
        q[name] = f"{TRIPS} {sql}"

    q["scan_json_raw"] = f"SELECT * {NO_ARRAYS} FROM ({raw()})"
    q["scan_parquet"] = q["gold_monthly_stats"]
    q["catalog_table_read"] = q["gold_monthly_stats"]
    q["sink_full_refresh"] = q["gold_weekly_stats"]
    q["sink_parquet_zstd"] = q["silver_activities"]
    q["bucketed_activity_fact"] = q["silver_activity_fact"]
    q["scan_union_by_name"] = f"{TRIPS} SELECT * FROM trips"
    published = ", ".join(f"{t} AS ({(GOLD | STAR)[t]})" for t in PUBLISHED)
    q["publish_gold"] = f"{ALL}, {published} " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({k} AS VARCHAR) AS row_key, CAST({v} AS VARCHAR) AS row_value FROM {t}"
        for t, (k, v) in PUBLISHED.items()
    )

    q["high_watermark"] = f"SELECT MAX(start_date::TIMESTAMP) AS high_watermark FROM ({raw()})"
    q["incremental_filter"] = f"""
        SELECT * {NO_ARRAYS}, CAST(2 AS BIGINT) AS batch_seq, id AS row_seq FROM ({raw(SECOND, 1)})
        WHERE start_date::TIMESTAMP > DATE_TRUNC('second', ({FIRST_WATERMARK}))"""
    q["child_worklist"] = f"""
        SELECT id AS activity_id, COALESCE(comment_count, 0) AS comment_count, COALESCE(kudos_count, 0) AS kudos_count,
               COALESCE(comment_count, 0) > 0 AS needs_comments, COALESCE(kudos_count, 0) > 0 AS needs_kudos
        FROM ({raw()}) WHERE COALESCE(comment_count, 0) > 0 OR COALESCE(kudos_count, 0) > 0"""
    q["child_key_stamp"] = _children("comments")
    q["anti_join_new_ids"] = NEW_IN_SECOND
    q["bronze_first_run"] = f"SELECT {BRONZE_ACTIVITIES_COLS} FROM ({_latest(LANDED, 'id')})"
    q["bronze_incremental"] = f"{BRONZE_FIRST} UNION ALL {NEW_IN_SECOND}"
    q["merge_activities"] = f"SELECT * {NO_ARRAYS} FROM ({_latest(LANDED, 'id')})"
    q["merge_comments"] = _latest(_children("comments"), "id")
    q["merge_kudos"] = _latest(_children("kudos"), "activity_id, firstname, lastname")
    q["pk_violations"] = f"""
        SELECT activity_id, COUNT(*) AS occurrences FROM ({BRONZE_FIRST} UNION ALL {BRONZE_SECOND})
        GROUP BY 1 HAVING COUNT(*) > 1"""
    totals = []
    for value, prefix in (("Run", "run"), ("Ride", "ride"), ("Swim", "swim")):
        totals += [
            f"CAST(SUM(CASE WHEN type = '{value}' THEN 1 ELSE 0 END) AS BIGINT) AS {prefix}_count",
            f"SUM(CASE WHEN type = '{value}' THEN distance ELSE 0.0 END) AS {prefix}_distance",
            f"CAST(SUM(CASE WHEN type = '{value}' THEN moving_time ELSE 0 END) AS BIGINT) AS {prefix}_moving_time",
            f"SUM(CASE WHEN type = '{value}' THEN total_elevation_gain ELSE 0.0 END) AS {prefix}_elevation_gain",
        ]
    q["athlete_stats"] = f"SELECT athlete_id, {', '.join(totals)} FROM ({raw()}) GROUP BY athlete_id"
    q["landed_activities"] = f"SELECT * EXCLUDE (start_latlng, end_latlng, row_seq) FROM ({LANDED})"
    q["landed_comments"] = f"SELECT * EXCLUDE (row_seq) FROM ({_children('comments')})"
    q["landed_kudos"] = f"SELECT * EXCLUDE (row_seq) FROM ({_children('kudos')})"
    q["landed_stats"] = f"SELECT athlete_id, batch_seq, {', '.join(totals)} FROM ({LANDED}) GROUP BY athlete_id, batch_seq"
    q["landed_athlete"] = """SELECT c_custkey AS id, split_part(c_name, '#', 1) AS firstname, '#' || split_part(c_name, '#', 2) AS lastname,
        CAST(NULL AS VARCHAR) AS city, c_mktsegment AS country, unnest([1::BIGINT, 2::BIGINT]) AS batch_seq FROM customer"""
    q["validate_layers"] = f"""{ALL}
        SELECT 'raw_activities' AS source, 'bronze_activities' AS target,
               (SELECT COUNT(*) FROM raw_activities) AS source_rows, (SELECT COUNT(*) FROM bronze_activities) AS target_rows
        UNION ALL
        SELECT 'bronze_activities', 'silver_activity_fact',
               (SELECT COUNT(*) FROM bronze_activities), (SELECT COUNT(*) FROM silver_activity_fact)"""
    q["stream_bronze"] = BRONZE_ALL
    q["stream_merge"] = q["merge_activities"]
    return q
