"""Activity, child and trip relations derived from the driver's tables.

The reference ingests JSON from a fitness API and a public taxi-trip dataset.
Neither is available here, so both are *derived by Spark* from the given
tables, one output row per input row (pure projections, no shuffle), so the
work of every query grows with ``orders`` and ``lineitem``:

* one activity per ``orders`` row (athlete = customer), nested like the API's
  JSON (``athlete`` and ``map`` structs, lat/lng arrays);
* comments and kudos generated per activity from its own counts;
* one trip per ``lineitem`` row plus one per ``orders`` row, the two sources
  differing in column order, a column's letter case and an INT/BIGINT type,
  like the monthly trip files the reference reads by name.

The same derivations are written in DuckDB SQL in ``oracle/duckdb_sql.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.schemas import RAW_ACTIVITY

# Fixed values of the derivation (must equal the oracle's):
# order priority -> activity type; status 'P' turns Run/Ride into TrailRun/VirtualRide.
PRIORITY_TYPES = [
    ("1-URGENT", "Run"),
    ("2-HIGH", "Ride"),
    ("3-MEDIUM", "Swim"),
    ("4-NOT SPECIFIED", "WeightTraining"),
]
DEFAULT_TYPE = "Yoga"
# customer key mod 4 -> (city, country, utc offset seconds, zone label)
PLACES = [
    ("Berlin", "Germany", 3600.0, "(GMT+01:00) Europe/Berlin"),
    ("Amsterdam", "Netherlands", 3600.0, "(GMT+01:00) Europe/Amsterdam"),
    ("Zurich", "Switzerland", 3600.0, "(GMT+01:00) Europe/Zurich"),
    (None, None, -18000.0, "(GMT-05:00) America/New_York"),
]
# Landing batches: a full fetch, then a re-fetch overlapping its last quarter
# (records fetched twice carry one more kudo the second time).
FIRST_FETCH_BEFORE = "2000-01-01"
REFETCH_FROM = "1999-10-01"


# Input contract: the columns of the driver tables this package reads.
# A declared schema skips Parquet schema inference (footer reads on every
# plan) and fails loudly if an input's types change.
INPUT_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
    " l_shipdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in INPUT_SCHEMAS:
        return spark.read.schema(INPUT_SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def _sql_case(operand: str, pairs, default: str) -> str:
    whens = " ".join(f"WHEN {k} THEN {v}" for k, v in pairs)
    return f"CASE {operand} {whens} ELSE {default} END"


def _q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "\\'") + "'"


ISO_TEXT = "\"yyyy-MM-dd'T'HH:mm:ss'Z'\""


def activities_from_orders(orders: DataFrame, kudos_bump: int = 0) -> DataFrame:
    """One API-shaped activity record per order (schema ``RAW_ACTIVITY``).

    Written as SQL expressions: the fixture has ~60 output columns, and
    building them one ``pyspark.sql.functions`` call at a time costs
    thousands of driver-JVM round trips per query plan. The activity kind,
    start time and moving time are computed in an inner projection and
    referenced by name, so each is evaluated once per row.
    """
    place = [
        _sql_case(
            "pmod(o_custkey, 4)",
            [(i, f"{p[2]}D" if pos == 2 else _q(p[pos])) for i, p in enumerate(PLACES)],
            "NULL",
        )
        for pos in range(4)
    ]
    kind = _sql_case("o_orderpriority", [(_q(k), _q(v)) for k, v in PRIORITY_TYPES], _q(DEFAULT_TYPE))
    base = orders.selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "o_orderstatus",
        f"{kind} AS _kind",
        "timestampadd(SECOND, pmod(o_orderkey * 7919, 86400), o_orderdate) AS _start",
        "CAST(floor(o_totalprice * CAST(50 + pmod(o_custkey, 50) AS DOUBLE) / 5000.0D) AS BIGINT) + 300 AS _moving",
        f"{place[2]} AS _offset",
    ).selectExpr(
        "*",
        "CASE WHEN _kind = 'Run' THEN o_totalprice / 40.0D WHEN _kind = 'Ride' THEN o_totalprice / 8.0D"
        " WHEN _kind = 'Swim' THEN o_totalprice / 400.0D ELSE 0.0D END AS _distance",
        "CASE WHEN o_orderstatus = 'P' AND _kind = 'Run' THEN 'TrailRun'"
        " WHEN o_orderstatus = 'P' AND _kind = 'Ride' THEN 'VirtualRide' ELSE _kind END AS _sport",
        "_kind IN ('Run', 'Ride') AS _outdoor",
        "52.0D + pmod(o_custkey, 100) / 100.0D AS _lat",
        "13.0D + pmod(o_orderkey, 100) / 100.0D AS _lng",
    )
    cols = {
        "id": "o_orderkey",
        "athlete": "named_struct('id', o_custkey, 'resource_state', CAST(1 AS BIGINT))",
        "name": "concat('Activity ', CAST(o_orderkey AS STRING))",
        "type": "_kind",
        "sport_type": "_sport",
        "workout_type": "CASE WHEN _kind = 'Run' THEN CAST(pmod(o_custkey, 4) AS INT) END",
        "device_name": "CASE WHEN o_orderstatus = 'F' THEN 'Garmin Forerunner 255'"
        " WHEN o_orderstatus = 'O' THEN 'Apple Watch Ultra' END",
        "start_date": f"date_format(_start, {ISO_TEXT})",
        "start_date_local": f"date_format(timestampadd(SECOND, CAST(_offset AS BIGINT), _start), {ISO_TEXT})",
        "timezone": place[3],
        "utc_offset": "_offset",
        "distance": "_distance",
        "moving_time": "_moving",
        "elapsed_time": "_moving + pmod(o_orderkey, 600)",
        "total_elevation_gain": "CASE WHEN _kind = 'Run' THEN o_totalprice / 4000.0D"
        " WHEN _kind = 'Ride' THEN o_totalprice / 1000.0D ELSE 0.0D END",
        "average_speed": "_distance / _moving",
        "max_speed": "_distance / _moving * 1.5D",
        "elev_high": "CASE WHEN _outdoor THEN CAST(200 + pmod(o_custkey, 300) AS DOUBLE) END",
        "elev_low": "CASE WHEN _outdoor THEN CAST(150 + pmod(o_custkey, 50) AS DOUBLE) END",
        "has_heartrate": "o_orderstatus <> 'P'",
        "average_heartrate": "CAST(95 + pmod(o_custkey, 90) AS DOUBLE)",
        "max_heartrate": "CAST(110 + pmod(o_custkey, 90) + pmod(o_orderkey, 10) AS DOUBLE)",
        "heartrate_opt_out": "false",
        "display_hide_heartrate_option": "o_orderstatus <> 'P'",
        "achievement_count": "pmod(o_orderkey, 4)",
        "kudos_count": f"pmod(o_custkey + o_orderkey, 7) + {int(kudos_bump)}",
        "comment_count": "pmod(o_orderkey, 3)",
        "athlete_count": "1 + pmod(o_orderkey, 2)",
        "photo_count": "CAST(0 AS BIGINT)",
        "total_photo_count": "pmod(o_orderkey, 2)",
        "pr_count": "CASE WHEN _kind = 'Run' THEN pmod(o_orderkey, 3) ELSE CAST(0 AS BIGINT) END",
        "location_city": place[0],
        "location_state": "CAST(NULL AS STRING)",
        "location_country": place[1],
        "map": "named_struct('id', concat('a', CAST(o_orderkey AS STRING)),"
        " 'summary_polyline', CASE WHEN _outdoor THEN concat('poly_', CAST(o_orderkey AS STRING)) ELSE '' END,"
        " 'resource_state', CAST(2 AS BIGINT))",
        "start_latlng": "CASE WHEN _outdoor THEN array(_lat, _lng) ELSE CAST(array() AS ARRAY<DOUBLE>) END",
        "end_latlng": "CASE WHEN _outdoor THEN array(_lat + 0.01D, _lng + 0.01D)"
        " ELSE CAST(array() AS ARRAY<DOUBLE>) END",
        "trainer": "_sport = 'VirtualRide'",
        "commute": "_kind = 'Ride' AND pmod(o_orderkey, 5) = 0",
        "manual": "false",
        "private": "pmod(o_custkey, 10) = 0",
        "visibility": "CASE WHEN pmod(o_custkey, 10) = 0 THEN 'only_me' ELSE 'everyone' END",
        "flagged": "false",
        "gear_id": "CASE WHEN _outdoor THEN concat('g', CAST(o_custkey AS STRING)) END",
        "upload_id": "o_orderkey + 1000000",
        "upload_id_str": "CAST(o_orderkey + 1000000 AS STRING)",
        "external_id": "concat('garmin_push_', CAST(o_orderkey AS STRING))",
        "from_accepted_tag": "false",
        "has_kudoed": "false",
        "resource_state": "CAST(2 AS BIGINT)",
    }
    return base.selectExpr(
        *[f"CAST({cols[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in RAW_ACTIVITY.fields]
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders")


def raw_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged raw activity table: every order as one activity."""
    return activities_from_orders(_orders(spark, sf_dir))


def activity_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed fetches with their order columns (``batch_seq``, ``row_seq``).

    Batch 1 holds activities started before ``FIRST_FETCH_BEFORE``; batch 2
    re-fetches from ``REFETCH_FROM`` on, so the last quarter of batch 1 arrives
    twice with one more kudo. ``row_seq`` is the record's position in its fetch.
    """
    orders = _orders(spark, sf_dir)
    first = activities_from_orders(orders.where(F.col("o_orderdate") < F.lit(FIRST_FETCH_BEFORE).cast("timestamp_ntz")))
    second = activities_from_orders(
        orders.where(F.col("o_orderdate") >= F.lit(REFETCH_FROM).cast("timestamp_ntz")), kudos_bump=1
    )
    return first.withColumns({"batch_seq": F.lit(1).cast("bigint"), "row_seq": F.col("id")}).unionByName(
        second.withColumns({"batch_seq": F.lit(2).cast("bigint"), "row_seq": F.col("id")})
    )


def child_fetches(worklist: DataFrame) -> DataFrame:
    """What the per-parent comment/kudos calls return, one row per parent.

    ``worklist`` carries ``activity_id``, ``comment_count``, ``kudos_count``
    and ``batch_seq``. Comment k of activity a has id ``a * 10 + k``; kudo k is
    given by athlete ``Fan K<(a + k) mod 5>``, so activities with more than
    five kudos repeat a giver, which the keyed merge must collapse.
    A re-fetch (batch 2) returns edited comment text.
    """
    aid = F.col("activity_id")
    edited = F.when(F.col("batch_seq") > F.lit(1), F.lit(" (edited)")).otherwise(F.lit(""))
    comments = F.transform(
        F.sequence(F.lit(1).cast("bigint"), F.col("comment_count")),
        lambda k: F.struct(
            (aid * F.lit(10) + k).alias("id"),
            F.concat(F.lit("Nice one #"), k.cast("string"), edited).alias("text"),
            F.lit("2024-01-01T00:00:00Z").alias("created_at"),
            F.struct(F.lit("Fan").alias("firstname"), F.concat(F.lit("C"), k.cast("string")).alias("lastname")).alias(
                "athlete"
            ),
        ),
    )
    kudos = F.transform(
        F.sequence(F.lit(1).cast("bigint"), F.col("kudos_count")),
        lambda k: F.struct(
            F.lit("Fan").alias("firstname"),
            F.concat(F.lit("K"), F.pmod(aid + k, F.lit(5)).cast("string")).alias("lastname"),
            F.lit(2).cast("bigint").alias("resource_state"),
        ),
    )
    empty = F.lit(0).cast("bigint")
    return worklist.select(
        aid.alias("parent_id"),
        F.col("batch_seq"),
        F.when(F.col("comment_count") > empty, comments).otherwise(F.array()).alias("comments"),
        F.when(F.col("kudos_count") > empty, kudos).otherwise(F.array()).alias("kudos"),
    )


def athletes_from_customers(customer: DataFrame) -> DataFrame:
    """raw_athlete records: one per customer (the athlete behind activities)."""
    name = F.col("c_name")
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.split(name, "#").getItem(0).alias("firstname"),
        F.concat(F.lit("#"), F.split(name, "#").getItem(1)).alias("lastname"),
        F.lit(None).cast("string").alias("city"),
        F.col("c_mktsegment").alias("country"),
    )


def yellow_trips(lineitem: DataFrame) -> DataFrame:
    """Trip records from line items (one per row)."""
    return lineitem.selectExpr(
        "*",
        "timestampadd(MINUTE, pmod(l_orderkey * 37 + l_linenumber * 11, 1440), l_shipdate) AS _pickup",
        "pmod(l_partkey, 6) AS _pay",
        "CASE WHEN l_discount = 0.0D THEN 0.0D ELSE l_extendedprice / 1000.0D END AS _fare",
        "l_extendedprice / 1000.0D * l_tax AS _tip",
    ).selectExpr(
        "CAST(1 + pmod(l_suppkey, 2) AS INT) AS VendorID",
        "_pickup AS tpep_pickup_datetime",
        "timestampadd(MINUTE, 5 + CAST(floor(l_quantity) AS BIGINT), _pickup) AS tpep_dropoff_datetime",
        "CAST(l_linenumber - 1 AS BIGINT) AS passenger_count",
        "l_quantity / 5.0D AS trip_distance",
        "CAST(_pay AS BIGINT) AS payment_type",
        "_fare AS fare_amount",
        "_tip AS tip_amount",
        "0.5D AS mta_tax",
        "CASE WHEN _pay = 4 THEN -(_fare + _tip + 0.5D) ELSE _fare + _tip + 0.5D END AS total_amount",
        "CASE WHEN l_tax >= 0.07D THEN 1.25D ELSE 0.0D END AS airport_fee",
    )


def order_trips(orders: DataFrame) -> DataFrame:
    """Trip records from orders: other column order, ``Airport_fee`` spelled
    with a capital, BIGINT vendor id and no passenger count."""
    pickup = "timestampadd(MINUTE, pmod(o_orderkey * 53, 1440), o_orderdate)"
    return orders.selectExpr(
        f"{pickup} AS tpep_pickup_datetime",
        f"timestampadd(MINUTE, 20, {pickup}) AS tpep_dropoff_datetime",
        "CAST(2 AS BIGINT) AS VendorID",
        "CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS payment_type",
        "o_totalprice / 50000.0D AS trip_distance",
        "o_totalprice / 10000.0D AS fare_amount",
        "0.0D AS tip_amount",
        "0.5D AS mta_tax",
        "o_totalprice / 10000.0D + 0.5D AS total_amount",
        "0.0D AS Airport_fee",
    )


def trip_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [yellow_trips(read_table(spark, sf_dir, "lineitem")), order_trips(read_table(spark, sf_dir, "orders"))]
