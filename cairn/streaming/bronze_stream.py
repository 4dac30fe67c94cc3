"""Repeated-run ingest as a file stream: only new keys are appended.

``readStream`` over the landing folder picks up each landed file once (the
checkpoint remembers which), ``maxFilesPerTrigger`` bounds a micro-batch, and
``trigger(availableNow=True)`` drains what is there and stops, which is what a
scheduled incremental run is. ``foreachBatch`` anti-joins each micro-batch
against the bronze table itself (not ``dropDuplicates`` state, which would
grow with all history) and writes ``batch=<epoch>``; a retried epoch
overwrites only its own directory and is compared with the history before it,
so the effect is exactly once although ``foreachBatch`` is at-least-once.

Batches are laid out by key and their commits hold their key ranges, so a
micro-batch opens only the batches whose keys it can meet: a backlog of n files
with keys of their own costs n, not n squared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import bronze, ingest
from cairn.plans.lake import Lake
from cairn.schemas import BRONZE_ACTIVITIES, BRONZE_KEY, ORDER_COLS, RAW_ACTIVITY_LANDED


# Rows that a task sorts as it writes a micro-batch, on average at most: more
# partitions than the session's are taken where these would hold more.
SORTED_ROWS = 250_000


def ingest_bronze_stream(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    checkpoint: str,
    max_files_per_trigger: int = 64,
) -> None:
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def append_new(batch: DataFrame, epoch_id: int) -> None:
        # The table's columns alone, and each record's place among what was read, so
        # that no two tie; read for the key ranges, the keys and the rows.
        batch = bronze.activities(batch, ORDER_COLS).withColumn("place", F.monotonically_increasing_id()).persist()
        try:
            parts = -(-batch.count() // SORTED_ROWS)  # the stream's own session: the caller's stays as it is
            batch.sparkSession.conf.set("spark.sql.shuffle.partitions", str(max(few, parts)))
            ranges = ingest.key_ranges(batch)
            history = lake.read_batches("bronze", "bronze_activities", BRONZE_ACTIVITIES, exclude=epoch_id, ranges=ranges)
            # keys meet the history before their rows are moved
            fresh = lambda keys: ingest.new_keys_only(keys, history, ranges=ranges)
            new = ingest.keyed_merge(batch, [BRONZE_KEY], [*ORDER_COLS, "place"], among=fresh, unique=True)
            lake.append_batch(new.drop(*ORDER_COLS, "place"), "bronze", "bronze_activities", epoch_id, key=BRONZE_KEY)
        finally:
            batch.unpersist()

    query = (
        spark.readStream.schema(RAW_ACTIVITY_LANDED)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(landing)
        .writeStream.foreachBatch(append_new)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def read_bronze(lake: Lake) -> DataFrame:
    return lake.read_batches("bronze", "bronze_activities", BRONZE_ACTIVITIES).select(*BRONZE_ACTIVITIES.names)
