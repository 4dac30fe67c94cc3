"""Registered queries: one callable per operator of the inventory.

Every callable takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` (or files Spark derived from them) and returns a DataFrame. Those
that exercise sinks or streams write under the session's shared folder
(``spark.checkpoint.dir``) and return what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import parse_ts_ntz
from cairn.operators import bronze, dims, gold, ingest, quality, trips
from cairn.plans import medallion
from cairn.plans.bucketed import FACT_SOURCES, BucketedLayer, buckets_for
from cairn.plans.medallion import Layers
from cairn.plans.lake import Lake
from cairn.plans.publish import listing, publish
from cairn.schemas import (
    BRONZE_ACTIVITIES,
    BRONZE_KEY,
    LANDED_COMMENT,
    LANDED_KUDO,
    MERGE_KEYS,
    ORDER_COLS,
    RAW_ACTIVITY,
    RAW_ACTIVITY_LANDED,
    RAW_ATHLETE,
    RAW_STATS,
)
from cairn.session import ensure_semantics, shared_dir
from cairn.sources import fixtures, landing
from cairn.sources import files as file_sources
from cairn.sources.files import read_json_records, read_or_empty, union_by_name
from cairn.streaming.bronze_stream import ingest_bronze_stream, read_bronze
from cairn.streaming.merge_stream import merge_stream, merged

Query = Callable[[SparkSession, str], DataFrame]


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def flatten_raw(df: DataFrame) -> DataFrame:
    """Raw activity records with struct fields lifted to columns (arrays
    dropped), so they compare column by column."""
    out = []
    for f in RAW_ACTIVITY.fields:
        if f.name == "athlete":
            out += ["athlete.id AS athlete_id", "athlete.resource_state AS athlete_resource_state"]
        elif f.name == "map":
            out += ["map.id AS map_id", "map.summary_polyline AS map_summary_polyline", "map.resource_state AS map_resource_state"]
        elif f.name not in ("start_latlng", "end_latlng"):
            out.append(f.name)
    out += [c for c in ORDER_COLS if c in df.columns]
    return df.selectExpr(*out)


# ---------------------------------------------------------------- layers
def _raw(spark, sf_dir):
    ensure_semantics(spark)
    return fixtures.raw_activities(spark, sf_dir)


def _layers(spark, sf_dir, single_source: bool = True) -> Layers:
    def athletes():
        return fixtures.athletes_from_customers(fixtures.read_table(spark, sf_dir, "customer"))

    return Layers(_raw(spark, sf_dir), athletes, single_source=single_source)


def _fact(spark, sf_dir):
    return _layers(spark, sf_dir).fact


def _trips(spark, sf_dir):
    ensure_semantics(spark)
    return union_by_name(fixtures.trip_sources(spark, sf_dir))


def _history_and_batch(spark, sf_dir):
    """Bronze history = fetch 1; incoming = fetch 2 (overlapping re-fetch)."""
    ensure_semantics(spark)
    landed = fixtures.activity_batches(spark, sf_dir)
    first = landed.where(F.col("batch_seq") == F.lit(1))
    second = landed.where(F.col("batch_seq") == F.lit(2))
    return first, second


# ---------------------------------------------------------------- scans / sinks
def scan_json_raw(spark, sf_dir):
    root = _scratch(spark, "landing")
    landing.write_ndjson(_raw(spark, sf_dir), f"{root}/raw_activities")
    return flatten_raw(read_json_records(spark, f"{root}/raw_activities", RAW_ACTIVITY))


def scan_parquet(spark, sf_dir):
    lake = Lake(spark, _scratch(spark, "lake"))
    path, _ = lake.write_version(gold.monthly_stats(_fact(spark, sf_dir)), "gold", "gold_monthly_stats")
    return spark.read.parquet(path)


def scan_union_by_name(spark, sf_dir):
    root = _scratch(spark, "trips")
    paths = []
    for i, df in enumerate(fixtures.trip_sources(spark, sf_dir)):
        df.write.mode("overwrite").parquet(f"{root}/part{i}.parquet")
        paths.append(f"{root}/part{i}.parquet")
    return file_sources.scan_union_by_name(spark, paths)


def catalog_table_read(spark, sf_dir):
    lake = Lake(spark, _scratch(spark, "lake"))
    lake.write_version(gold.monthly_stats(_fact(spark, sf_dir)), "gold", "gold_monthly_stats")
    publish(spark, lake, ["gold_monthly_stats"])
    return spark.table("gold.gold_monthly_stats_table")


def catalog_listing(spark, sf_dir):
    _publish_all(spark, sf_dir)
    return listing(spark)


def sink_full_refresh(spark, sf_dir):
    lake = Lake(spark, _scratch(spark, "lake"))
    weekly = _layers(spark, sf_dir).gold("gold_weekly_stats")
    lake.write_version(weekly.where(F.col("activity_count") > F.lit(1)), "gold", "gold_weekly_stats")
    lake.write_version(weekly, "gold", "gold_weekly_stats")  # replaces, never overwrites in place
    return lake.read("gold", "gold_weekly_stats")


def sink_parquet_zstd(spark, sf_dir):
    lake = Lake(spark, _scratch(spark, "lake"))
    path, _ = lake.write_version(_layers(spark, sf_dir).silver("silver_activities"), "silver", "silver_activities")
    return spark.read.parquet(path)


def _publish_all(spark, sf_dir) -> Lake:
    lake = Lake(spark, _scratch(spark, "lake"))
    layers = _layers(spark, sf_dir)
    fact_path, _ = lake.write_version(layers.fact, "silver", "silver_activity_fact")
    fact = spark.read.parquet(fact_path)  # gold reads the written fact, not its lineage
    for name, df in medallion.gold_tables(fact).items():
        lake.write_version(df, "gold", name)
    for name, df in medallion.star_tables(fact, layers.bronze("bronze_activities"), layers.athletes).items():
        lake.write_version(df, "gold", name)
    publish(spark, lake)
    return lake


def publish_gold(spark, sf_dir):
    """Every published row: its table, its key and one of its measures."""
    _publish_all(spark, sf_dir)
    return union_by_name(
        [
            spark.table(f"gold.{t}_table").selectExpr(f"'{t}' AS table_name", f"CAST({key} AS STRING) AS row_key", f"CAST({value} AS STRING) AS row_value")
            for t, (key, value) in PUBLISHED.items()
        ]
    )


def _landed(name: str, schema, names: list[str] | None = None) -> Query:
    """Array landings of both fetches, read with their order columns."""

    def query(spark, sf_dir):
        root = _scratch(spark, "landing")
        parts = []
        for seq, folder in enumerate(landing.write_landings(spark, sf_dir, root, names=(name,)), 1):
            parts.append(file_sources.read_landed(spark, f"{folder}/{name}", schema, seq))
        both = union_by_name(parts).drop("row_seq")
        return both.selectExpr(*names, "batch_seq") if names else flatten_raw(both)

    return query


# What publish_gold shows of each table (key, measure).
PUBLISHED = {
    "gold_activity_summary": ("activity_id", "kudos_count"),
    "gold_weekly_stats": ("date_format(week_start, 'yyyy-MM-dd')", "activity_count"),
    "gold_monthly_stats": ("date_format(month_start, 'yyyy-MM-dd')", "activity_count"),
    "gold_pb_efforts": ("activity_id", "pr_count"),
    "gold_training_load": ("activity_id", "CAST(average_heartrate AS BIGINT)"),
    "dim_date": ("date_id", "week_number"),
    "dim_activity_type": ("athlete_id", "sport_category"),
    "dim_athlete": ("athlete_id", "athlete_name"),
    "fact_activities": ("activity_id", "hr_zone"),
}


# ---------------------------------------------------------------- ingest
def high_watermark(spark, sf_dir):
    return ingest.high_watermark(_layers(spark, sf_dir).gold("gold_activity_summary"))


def incremental_filter(spark, sf_dir):
    first, second = _history_and_batch(spark, sf_dir)
    wm = ingest.high_watermark(Layers(first.drop(*ORDER_COLS)).gold("gold_activity_summary"))
    return flatten_raw(ingest.incremental_filter(second, wm, parse_ts_ntz(F.col("start_date"))))


def child_worklist(spark, sf_dir):
    return ingest.child_worklist(_raw(spark, sf_dir))


def _fetches(spark, sf_dir):
    landed = fixtures.activity_batches(spark, sf_dir)
    return fixtures.child_fetches(ingest.child_worklist(landed))


def child_key_stamp(spark, sf_dir):
    return ingest.stamp_comments(_fetches(spark, sf_dir))


def anti_join_new_ids(spark, sf_dir):
    first, second = _history_and_batch(spark, sf_dir)
    history = bronze.activities(first)
    return ingest.new_keys_only(bronze.activities(second), history)


def bronze_first_run(spark, sf_dir):
    first = fixtures.activity_batches(spark, sf_dir)  # a first load takes both fetches
    lake = Lake(spark, _scratch(spark, "lake"))
    history, is_first = read_or_empty(spark, lake.table_path("bronze", "bronze_activities"), BRONZE_ACTIVITIES)
    assert is_first
    new = ingest.new_keys_only(bronze.activities(ingest.keyed_merge(first, ["id"])), history)
    lake.append_batch(new, "bronze", "bronze_activities", 1, key=BRONZE_KEY, audit=lambda rows: quality.assert_new_and_unique(rows, None, BRONZE_KEY))
    return lake.read_batches("bronze", "bronze_activities", BRONZE_ACTIVITIES).select(*BRONZE_ACTIVITIES.names)


def bronze_incremental(spark, sf_dir):
    first, second = _history_and_batch(spark, sf_dir)
    lake = Lake(spark, _scratch(spark, "lake"))
    for batch_id, batch in ((1, first), (2, second)):
        ranges = ingest.key_ranges(batch, "id")
        history = lake.read_batches("bronze", "bronze_activities", BRONZE_ACTIVITIES, exclude=batch_id, ranges=ranges)
        new = ingest.new_keys_only(bronze.activities(ingest.keyed_merge(batch, ["id"])), history, ranges=ranges)
        past = history if batch_id > 1 else None
        lake.append_batch(
            new, "bronze", "bronze_activities", batch_id, key=BRONZE_KEY, audit=lambda rows, past=past: quality.assert_new_and_unique(rows, past, BRONZE_KEY)
        )
    return lake.read_batches("bronze", "bronze_activities", BRONZE_ACTIVITIES).select(*BRONZE_ACTIVITIES.names)


def merge_activities(spark, sf_dir):
    ensure_semantics(spark)
    landed = fixtures.activity_batches(spark, sf_dir)
    return flatten_raw(ingest.keyed_merge(landed, MERGE_KEYS["activities"]))


def merge_comments(spark, sf_dir):
    return ingest.keyed_merge(ingest.stamp_comments(_fetches(spark, sf_dir)), MERGE_KEYS["comments"])


def merge_kudos(spark, sf_dir):
    return ingest.keyed_merge(ingest.stamp_kudos(_fetches(spark, sf_dir)), MERGE_KEYS["kudos"])


def athlete_stats(spark, sf_dir):
    """The athlete-stats record per athlete, from all activities."""
    return ingest.athlete_totals(_raw(spark, sf_dir))


def pk_violations(spark, sf_dir):
    """Keys a plain append of both fetches would duplicate."""
    first, second = _history_and_batch(spark, sf_dir)
    return ingest.pk_violations(bronze.activities(first).unionByName(bronze.activities(second)))


# ---------------------------------------------------------------- layers as queries
def bronze_query(name: str) -> Query:
    return lambda spark, sf_dir: _layers(spark, sf_dir).bronze(name)


def silver_query(name: str) -> Query:
    # silver_activity_fact is registered in its general four-LEFT-join form;
    # gold and star queries build it as one projection (see Layers).
    single = name != "silver_activity_fact"
    return lambda spark, sf_dir: _layers(spark, sf_dir, single_source=single).silver(name)


def bucketed_activity_fact(spark, sf_dir):
    """The same fact from bronze tables bucketed by key, written in two batches."""
    buckets = buckets_for(_raw(spark, sf_dir).count())  # by the files' footers
    layer = BucketedLayer(spark, f"bronze_{uuid.uuid4().hex[:8]}", _scratch(spark, "bucketed"), buckets=buckets)
    early = F.coalesce(F.col("start_date") < F.lit(fixtures.FIRST_FETCH_BEFORE), F.lit(False))
    for batch_id, part in ((1, early), (2, ~early)):
        records = bronze.records(_raw(spark, sf_dir).where(part))
        for name in FACT_SOURCES:
            layer.write_batch(bronze.project(records, name), name, batch_id)
    return layer.silver_fact()


def gold_query(name: str) -> Query:
    return lambda spark, sf_dir: _layers(spark, sf_dir).gold(name)


def star_query(name: str) -> Query:
    return lambda spark, sf_dir: _layers(spark, sf_dir).star(name)


def gold_monthly_by_distance(spark, sf_dir):
    return gold.monthly_by_distance(_layers(spark, sf_dir).gold("gold_monthly_stats"))


def hr_zone_histogram(spark, sf_dir):
    return dims.hr_zone_histogram(_layers(spark, sf_dir).star("fact_activities"))


# ---------------------------------------------------------------- trips
def trip_query(fn) -> Query:
    return lambda spark, sf_dir: fn(_trips(spark, sf_dir))


# ---------------------------------------------------------------- checks / streams
def validate_layers(spark, sf_dir):
    """Counts of written tables, from their writes; raises where a hop gains or
    loses rows."""
    layers, lake = _layers(spark, sf_dir, single_source=False), Lake(spark, _scratch(spark, "lake"))
    for layer, name, df in (
        ("raw", "raw_activities", layers.raw),
        ("bronze", "bronze_activities", layers.bronze("bronze_activities")),
        ("silver", "silver_activity_fact", layers.fact),
    ):
        lake.write_version(df, layer, name)
    hops = [("raw", "raw_activities", "bronze", "bronze_activities"), ("bronze", "bronze_activities", "silver", "silver_activity_fact")]
    counts = quality.written_counts(spark, lake, hops)
    quality.validate_counts(counts, equal=True)
    return counts


def stream_bronze(spark, sf_dir):
    ensure_semantics(spark)
    root = _scratch(spark, "stream-bronze")
    landing.write_activity_batches(spark, sf_dir, f"{root}/landing")
    lake = Lake(spark, f"{root}/lake")
    ingest_bronze_stream(spark, f"{root}/landing/activities/*", lake, f"{root}/checkpoint")
    return read_bronze(lake)


def stream_merge(spark, sf_dir):
    ensure_semantics(spark)
    root = _scratch(spark, "stream-merge")
    landing.write_activity_batches(spark, sf_dir, f"{root}/landing")
    lake = Lake(spark, f"{root}/lake")
    merge_stream(
        spark, f"{root}/landing/activities/*", RAW_ACTIVITY_LANDED, MERGE_KEYS["activities"],
        lake, "raw_activities", f"{root}/checkpoint",
    )
    return flatten_raw(merged(lake, "raw_activities", MERGE_KEYS["activities"]))


def _pinned(fn: Query) -> Query:
    """Pin the session semantics the results depend on (UTC, ANSI) before
    the plan is built, whatever session the caller passes in."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_semantics(spark)
        return fn(spark, sf_dir)

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "scan_json_raw": scan_json_raw,
        "scan_parquet": scan_parquet,
        "scan_union_by_name": scan_union_by_name,
        "catalog_table_read": catalog_table_read,
        "catalog_listing": catalog_listing,
        "sink_full_refresh": sink_full_refresh,
        "sink_parquet_zstd": sink_parquet_zstd,
        "publish_gold": publish_gold,
        "high_watermark": high_watermark,
        "incremental_filter": incremental_filter,
        "child_worklist": child_worklist,
        "child_key_stamp": child_key_stamp,
        "anti_join_new_ids": anti_join_new_ids,
        "bronze_first_run": bronze_first_run,
        "bronze_incremental": bronze_incremental,
        "merge_activities": merge_activities,
        "merge_comments": merge_comments,
        "merge_kudos": merge_kudos,
        "pk_violations": pk_violations,
        "athlete_stats": athlete_stats,
        "landed_activities": _landed("activities", RAW_ACTIVITY),
        "landed_comments": _landed(
            "comments", LANDED_COMMENT, ["id", "activity_id", "text", "created_at", "athlete.firstname AS firstname", "athlete.lastname AS lastname"]
        ),
        "landed_kudos": _landed("kudos", LANDED_KUDO, LANDED_KUDO.names),
        "landed_stats": _landed(
            "stats", RAW_STATS, ["athlete_id"] + [f"all_{k}_totals.{m} AS {k}_{m}" for _, k in ingest.TOTAL_TYPES for m in ingest.TOTAL_FIELDS]
        ),
        "landed_athlete": _landed("athlete", RAW_ATHLETE, RAW_ATHLETE.names),
    }
    for name in ("bronze_heartrate", "bronze_metrics", "bronze_engagement", "bronze_location", "bronze_map", "bronze_geo"):
        q[name] = bronze_query(name)
    for name in medallion.SILVER_NAMES:
        q[name] = silver_query(name)
    for name in medallion.GOLD_NAMES:
        q[name] = gold_query(name)
    q["bucketed_activity_fact"] = bucketed_activity_fact
    q["gold_monthly_by_distance"] = gold_monthly_by_distance
    for name in medallion.STAR_NAMES:
        q[name] = star_query(name)
    q["hr_zone_histogram"] = hr_zone_histogram
    q.update(
        {
            "trips_row_count": trip_query(trips.row_count),
            "trips_revenue_by_month": trip_query(trips.revenue_by_month),
            "trips_busiest_hours": trip_query(trips.busiest_hours),
            "trips_tip_analysis": trip_query(trips.tip_analysis),
            "trips_payment_types": trip_query(trips.payment_types),
            "validate_layers": validate_layers,
            "stream_bronze": stream_bronze,
            "stream_merge": stream_merge,
        }
    )
    return {name: _pinned(fn) for name, fn in q.items()}
