"""End-to-end run: landing -> raw -> bronze -> silver -> gold -> star schema ->
publish, with the no-new-data gate and layer checks.

A landing is a folder with ``activities`` and, where they were fetched,
``comments``, ``kudos``, ``stats`` and ``athlete``: JSON arrays, single objects or
one record a line. Each layer is written to the lake and read back before the
next stage, so a lost executor only recomputes the current stage.

No run loses rows. A run works on every bronze batch that no finished run has
covered (its own and those of runs that failed), writes each again from bronze
on, and records them as finished in one last step. The watermark comes from
finished batches only, versioned tables start from the last finished version
or recompute what a batch touches, and the counts of bronze and fact must agree
before gold is written. So it doesn't matter whether a failed run is repeated
under its own batch id or followed by the next one.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions import parse_ts_ntz
from cairn.operators import bronze, dims, gold, ingest, quality
from cairn.plans import incremental, medallion
from cairn.plans.lake import Lake
from cairn.plans.publish import GOLD_TABLES, listing, publish
from cairn.schemas import BRONZE_KEY, LANDED_COMMENT, LANDED_KUDO, LANDED_ORDER, MERGE_KEYS, RAW_ACTIVITY, RAW_ATHLETE, RAW_STATS
from cairn.sources.files import path_exists, read_landed

log = logging.getLogger(__name__)

# Wide bronze table: every bronze column, keyed by activity_id.
RECORDS = "bronze_activity_records"
KEY_ONLY = T.StructType([T.StructField(BRONZE_KEY, T.LongType())])
APPENDED_GOLD = ("gold_activity_summary", "gold_training_load")


# Independent writes of one stage are submitted as concurrent Spark jobs from
# driver threads: each is small next to the cluster, and a stage waits for the
# slowest one instead of the sum of all.
WRITE_THREADS = 4


def _concurrently(writes: dict[str, Callable[[], tuple[str, int]]]) -> dict[str, int]:
    """Run independent writes as concurrent jobs; rows written per table."""
    with ThreadPoolExecutor(max_workers=WRITE_THREADS) as pool:
        futures = {name: pool.submit(fn) for name, fn in writes.items()}
        return {name: fut.result()[1] for name, fut in futures.items()}


def raw_view(lake: Lake, table: str) -> DataFrame:
    """The merged raw table (merge-on-read): last write wins per key over the
    compacted base and the landed batches after it, by their order columns."""
    return incremental.merge_on_read(lake, "raw", table, RAW_KEYS[table], LANDED_ORDER)


def compact_raw(lake: Lake) -> dict[str, int | None]:
    """Periodic maintenance: fold landed raw batches into a merged base."""
    return {table: incremental.compact(lake, "raw", table, keys, LANDED_ORDER) for table, keys in RAW_KEYS.items()}


RAW_KEYS = {
    "raw_activities": MERGE_KEYS["activities"],
    "raw_comments": MERGE_KEYS["comments"],
    "raw_kudos": MERGE_KEYS["kudos"],
}


def current_watermark(lake: Lake, finished: set[int], batch_id: int | None = None):
    """Newest start time in the gold of finished batches (the batch being retried
    excluded), read once per run as a single value (``None`` on a first run)."""
    ids = [b for b in lake.batches("gold", "gold_activity_summary") if b in finished and b != batch_id]
    if not ids:
        return None
    return ingest.high_watermark(lake.read_some("gold", "gold_activity_summary", ids)).first()[0]


def land(spark: SparkSession, lake: Lake, landing: str, activities: DataFrame, batch_id: int) -> dict[str, int]:
    """Append the landed records to raw with their order columns. The keyed
    last-write-wins merge happens on read (``raw_view``), so a run writes
    O(batch), never the whole raw history. Single-record files replace."""
    comments = ingest.landed_comments(read_landed(spark, f"{landing}/comments", LANDED_COMMENT, batch_id))
    kudos = read_landed(spark, f"{landing}/kudos", LANDED_KUDO, batch_id)
    writes = {
        "raw_activities": lambda: lake.append_batch(activities, "raw", "raw_activities", batch_id),
        "raw_comments": lambda: lake.append_batch(comments, "raw", "raw_comments", batch_id),
        "raw_kudos": lambda: lake.append_batch(kudos, "raw", "raw_kudos", batch_id),
    }
    for name, table, schema in (("athlete", "raw_athlete", RAW_ATHLETE), ("stats", "raw_stats_for_athlete", RAW_STATS)):
        if path_exists(spark, f"{landing}/{name}") or not lake.versions("raw", table):
            one = read_landed(spark, f"{landing}/{name}", schema, batch_id).drop(*LANDED_ORDER)
            writes[table] = lambda t=table, df=one: lake.write_version(df, "raw", t, version=batch_id)
    return _concurrently(writes)


def run(spark: SparkSession, lake: Lake, landing: str, batch_id: int, do_publish: bool = True) -> dict[str, int]:
    """One scheduled run over one landed batch. Returns rows written per table
    (empty dict when there was nothing new)."""
    counts: dict[str, int] = {}
    runs, finished = lake.finished()
    pending = [b for b in lake.batches("bronze", RECORDS) if b not in finished and b != batch_id]

    # watermark + incremental read + gate
    wm = current_watermark(lake, finished, batch_id)
    landed = read_landed(spark, f"{landing}/activities", RAW_ACTIVITY, batch_id)
    landed = ingest.incremental_filter(landed, wm, parse_ts_ntz(F.col("start_date")))
    # a record without a time always passes the filter; one seen before is not new
    old = lake.batches("bronze", RECORDS)
    ids = landed.select(F.col("id").alias(BRONZE_KEY))
    ranges = ingest.key_ranges(ids)
    # of the history only what can hold a key of this batch is opened and read
    # (an empty typed table on a first run)
    history = ingest.within(lake.read_batches("bronze", RECORDS, KEY_ONLY, exclude=batch_id, ranges=ranges), ranges)
    fresh = ingest.new_keys_only(ids, history)
    if fresh.isEmpty() and not pending and batch_id not in old:
        log.info("No new data — pipeline complete")
        return counts

    # raw: written once, then read back by everything below
    counts.update(land(spark, lake, landing, landed, batch_id))
    batch = ingest.keyed_merge(lake.read_some("raw", "raw_activities", [batch_id]), ["id"], LANDED_ORDER).drop(*LANDED_ORDER)

    # bronze: only keys not yet in history are appended (history is never
    # rewritten). The wide keyed record table is written first and is what
    # later runs compare with; the published tables are projections of it.
    new = bronze.records(batch).where("activity_id IS NOT NULL")
    new = ingest.new_keys_only(new, history)

    def audit(rows: DataFrame) -> None:
        quality.assert_new_and_unique(rows, history, BRONZE_KEY)

    # written aside, audited as the key it is, and only then readable
    _, counts[RECORDS] = lake.append_batch(new, "bronze", RECORDS, batch_id, key=BRONZE_KEY, audit=audit)
    work = sorted([*pending, batch_id])
    for b in work:
        records = lake.read_some("bronze", RECORDS, [b])
        tables = {("bronze", n): bronze.project(records, n) for n in bronze.TABLE_COLUMNS}
        # silver: per-key projections of the records (no join, no shuffle)
        tables |= {("silver", n): df for n, df in medallion.silver_tables_from_records(records).items()}
        wrote = _concurrently({key: (lambda k=key, d=df: lake.append_batch(d, *k, b)) for key, df in tables.items()})
        for (_, name), n in wrote.items():
            counts[name] = counts.get(name, 0) + n
    hops = [("bronze", RECORDS, "bronze", "bronze_activities"), ("bronze", "bronze_activities", "silver", "silver_activity_fact")]
    quality.validate_counts(quality.written_counts(spark, lake, hops), equal=True)

    # gold: per-row tables appended; rollups, top-k and dimensions merged exactly
    new_records = lake.read_some("bronze", RECORDS, work)
    new_fact = lake.read_some("silver", "silver_activity_fact", work)
    states = {}
    for b in work:
        part = lake.read_some("silver", "silver_activity_fact", [b])
        for name in gold.PERIODS:
            states[name, b] = lambda n=name, p=part, i=b: incremental.append_states(lake, n, p, i)
    _concurrently(states)
    owned = medallion.silver.activity_fact_from_records(new_records, owner=True)
    writes: dict[str, Callable[[], tuple[str, int]]] = {}
    for b in work:
        part = lake.read_some("silver", "silver_activity_fact", [b])
        own = medallion.silver.activity_fact_from_records(lake.read_some("bronze", RECORDS, [b]), owner=True)
        for name in APPENDED_GOLD:
            writes[f"{name}:{b}"] = lambda n=name, p=part, i=b: lake.append_batch(medallion.gold_tables_for(p, [n])[n], "gold", n, i)
        writes[f"fact_activities:{b}"] = lambda o=own, i=b: lake.append_batch(dims.activity_fact(o, None), "gold", "fact_activities", i)
    for name in gold.PERIODS:
        writes[name] = lambda n=name: lake.write_version(incremental.merged_periods(lake, n), "gold", n)
    writes["gold_pb_efforts"] = lambda: lake.write_version(incremental.refresh_top_paces(lake, new_fact), "gold", "gold_pb_efforts")
    for name, df in (("dim_date", dims.date_dim(new_fact)), ("dim_activity_type", dims.activity_type_dim(owned, None))):
        writes[name] = lambda n=name, d=df: lake.append_batch(incremental.new_members(lake, n, d, batch_id), "gold", n, batch_id)
    writes["dim_athlete"] = lambda: lake.write_version(
        incremental.refresh_athletes(lake, owned, lake.read("raw", "raw_athlete")), "gold", "dim_athlete"
    )
    # totals: those of the last finished run and this run's batches
    totals = ingest.athlete_totals(new_records, owner=F.col("athlete_id"))
    earlier = [v for v in lake.versions("gold", "athlete_totals") if v in runs and v < batch_id]
    if earlier:
        totals = ingest.merge_totals(lake.read_version("gold", "athlete_totals", earlier[-1]), totals)
    writes["athlete_totals"] = lambda: lake.write_version(totals, "gold", "athlete_totals", version=batch_id)
    for key, n in _concurrently(writes).items():
        name = key.partition(":")[0]
        counts[name] = counts.get(name, 0) + n

    if do_publish:
        publish(spark, lake)
        lost = quality.missing_tables(spark, listing(spark), [f"{t}_table" for t in GOLD_TABLES]).collect()
        if lost:
            raise ValueError(f"not published: {sorted(r.table_name for r in lost)}")
    lake.finish(batch_id, work)
    return counts
