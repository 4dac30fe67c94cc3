"""Bronze tables of the catalog, bucketed and sorted by key, one partition a batch.

Tables that are bucketed alike on ``activity_id`` join without an exchange: the
rows of a bucket meet in one task as they are. So the shuffle of the join chain
is paid once, when a batch is written, and never again by those who read.

A batch is one ``INSERT OVERWRITE`` of its partition, which becomes visible with
the catalog's commit, so a retried batch replaces only its own rows. All tables
of a layer have the same number of buckets, fixed when the layer is made, from
the rows of the history to be kept (``buckets_for``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cairn.operators import silver
from cairn.schemas import BRONZE_KEY
from cairn.sources.files import path_exists

# The bronze tables that the silver fact is joined from.
FACT_SOURCES = ("bronze_activities", "bronze_metrics", "bronze_heartrate", "bronze_engagement", "bronze_location")

# Rows of one bucket, about, and the least buckets of a layer.
BUCKET_ROWS = 250_000
LEAST_BUCKETS = 8


def buckets_for(rows: int) -> int:
    """Buckets of a layer for a history of so many rows. A task of the join chain
    sorts a bucket of each table, so with a longer history there are more tasks,
    not larger ones."""
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


class BucketedLayer:
    """Tables ``<schema>.<name>`` under ``root``, in ``buckets`` buckets by key."""

    def __init__(self, spark: SparkSession, schema: str, root: str, buckets: int = 64, key: str = BRONZE_KEY):
        self.spark, self.schema, self.root, self.buckets, self.key = spark, schema, root.rstrip("/"), buckets, key

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def _ensure(self, table: str, columns: T.StructType) -> None:
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema} LOCATION '{self.root}/_catalog'")  # a dropped schema takes its folder along
        if self.spark.catalog.tableExists(self.name(table)):
            return
        old = path_exists(self.spark, f"{self.root}/{table}")  # files of an earlier session
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        self.spark.sql(
            f"CREATE TABLE {self.name(table)} ({cols}, batch INT) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (batch)"
            f" CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.root}/{table}'"
        )
        if old:
            self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)}")

    def write_batch(self, df: DataFrame, table: str, batch_id: int) -> None:
        """One batch, replaced if it is there. Rows are dealt by key first, so
        each bucket is one sorted file."""
        self._ensure(table, df.schema)
        rows = df.repartition(self.buckets, self.key)
        cols = ", ".join(f"`{c}`" for c in df.columns)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name(table)} PARTITION (batch = {int(batch_id)}) SELECT {cols} FROM {{rows}}", rows=rows)

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table)).drop("batch")

    def silver_fact(self) -> DataFrame:
        """``silver_activity_fact`` by its four LEFT JOINs, without an exchange."""
        t = {name: self.read(name) for name in FACT_SOURCES}
        return silver.activity_fact(
            silver.activities(t["bronze_activities"], t["bronze_metrics"]),
            silver.heartrate(t["bronze_heartrate"]),
            silver.engagement(t["bronze_engagement"]),
            silver.location(t["bronze_location"]),
        )

    def drop(self) -> None:
        """The catalog entries; the files stay."""
        self.spark.sql(f"DROP SCHEMA IF EXISTS {self.schema} CASCADE")
