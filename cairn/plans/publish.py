"""Publish gold datasets to the catalog as ``gold.<table>_table``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.plans.lake import Lake
from cairn.plans.medallion import GOLD_NAMES, STAR_NAMES

GOLD_TABLES = [*GOLD_NAMES, *STAR_NAMES]
SCHEMA = "gold"


def ensure_schema(spark: SparkSession, lake: Lake, schema: str = SCHEMA) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{lake.root}/catalog/{schema}.db'")


def create_if_absent(spark: SparkSession, lake: Lake, table: str, schema: T.StructType, schema_name: str = SCHEMA) -> None:
    """``CREATE TABLE IF NOT EXISTS``: an empty typed table, or the one there."""
    ensure_schema(spark, lake, schema_name)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {schema_name}.{table} ({cols}) USING parquet LOCATION '{lake.root}/catalog/{schema_name}.db/{table}'")


def publish(spark: SparkSession, lake: Lake, tables: Sequence[str] = GOLD_TABLES, layer: str = "gold") -> list[str]:
    """Register the committed files of each gold dataset in the catalog.

    The reference copies each Parquet file into a remote warehouse. Here an
    entry is a view over the committed version or batch directories: publishing
    is a metadata change, not a copy, replaces the entry in one step, and never
    shows files of a write that did not finish.
    """
    ensure_schema(spark, lake)
    names = []
    for table in tables:
        name = f"{SCHEMA}.{table}_table"
        paths = [lake.latest_path(layer, table)] if lake.versions(layer, table) else lake.batch_paths(layer, table)
        parts = " UNION ALL ".join(f"SELECT * FROM parquet.`{path}`" for path in paths)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {parts}")
        names.append(name)
    return names


def listing(spark: SparkSession, schema: str = SCHEMA) -> DataFrame:
    """``information_schema.tables`` for one schema, ordered by name."""
    return (
        spark.sql(f"SHOW TABLES IN {schema}")
        .where(~F.col("isTemporary"))
        .select(
            F.col("namespace").alias("table_schema"),
            F.col("tableName").alias("table_name"),
            F.lit("BASE TABLE").alias("table_type"),
        )
        .orderBy("table_name")
    )
