"""Incremental ingest: watermark, new-key filter, keyed merge, child records.

The reference keeps a JSON file per entity and merges fetches in a Python
dict ("last write wins"). On Spark the same outcome is a keyed aggregate:
the greatest ``(batch_seq, row_seq)`` per key, found from the narrow columns, and
then the records that have it. However many records share one key (even a third
of all rows), no group is collected into a list or sent to one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.schemas import BRONZE_KEY, LANDED_ORDER, ORDER_COLS


def high_watermark(summary: DataFrame, ts_col: str = "start_date_utc") -> DataFrame:
    """``SELECT MAX(ts)``: one row, NULL when the history is empty."""
    return summary.agg(F.max(ts_col).alias("high_watermark"))


def watermark_value(watermark: DataFrame) -> Column:
    """The watermark as a scalar subquery column (no driver round trip)."""
    return watermark.select("high_watermark").scalar()


def incremental_filter(records: DataFrame, watermark, ts: Column) -> DataFrame:
    """Records strictly newer than the watermark, truncated to whole seconds
    (the API takes a unix second). With no watermark (empty history)
    everything passes, i.e. a full load. A record without a time may be new, so
    it passes too; the key difference decides on it.

    ``watermark`` is the one-row ``high_watermark`` frame (a scalar subquery,
    one plan) or an already-read value (``datetime`` or ``None``) when the
    same filter is evaluated several times.
    """
    if isinstance(watermark, DataFrame):
        mark = watermark_value(watermark)
    elif watermark is None:
        return records
    else:  # from ISO text: independent of the driver's local time zone
        mark = F.lit(watermark.isoformat(sep=" ")).cast("timestamp_ntz")
    wm = F.date_trunc("second", mark).cast("timestamp_ntz")
    return records.where(wm.isNull() | ts.isNull() | (ts > wm))


def child_worklist(parents: DataFrame) -> DataFrame:
    """Parents whose children must be fetched: any comment or any kudo.
    A missing count counts as zero."""
    comments = F.coalesce(F.col("comment_count"), F.lit(0).cast("bigint"))
    kudos = F.coalesce(F.col("kudos_count"), F.lit(0).cast("bigint"))
    return parents.where((comments > F.lit(0)) | (kudos > F.lit(0))).select(
        F.col("id").alias("activity_id"),
        comments.alias("comment_count"),
        kudos.alias("kudos_count"),
        (comments > F.lit(0)).alias("needs_comments"),
        (kudos > F.lit(0)).alias("needs_kudos"),
        *([F.col("batch_seq")] if "batch_seq" in parents.columns else []),
    )


def landed_comments(records: DataFrame) -> DataFrame:
    """Landed comments, each with its parent's key, flat."""
    return records.selectExpr(
        "id", "activity_id", "text", "created_at", "athlete.firstname AS firstname", "athlete.lastname AS lastname", *LANDED_ORDER
    )


def stamp_comments(fetches: DataFrame) -> DataFrame:
    """Explode per-parent comment arrays and stamp the parent key on each.
    ``row_seq`` is the record's position in the fetch (parent, index)."""
    c = F.col("c")
    return fetches.select("parent_id", "batch_seq", F.posexplode("comments").alias("pos", "c")).select(
        c["id"].alias("id"),
        F.col("parent_id").alias("activity_id"),
        c["text"].alias("text"),
        c["created_at"].alias("created_at"),
        c["athlete"]["firstname"].alias("firstname"),
        c["athlete"]["lastname"].alias("lastname"),
        "batch_seq",
        (F.col("parent_id") * F.lit(1000) + F.col("pos")).alias("row_seq"),
    )


def stamp_kudos(fetches: DataFrame) -> DataFrame:
    k = F.col("k")
    return fetches.select("parent_id", "batch_seq", F.posexplode("kudos").alias("pos", "k")).select(
        F.col("parent_id").alias("activity_id"),
        k["firstname"].alias("firstname"),
        k["lastname"].alias("lastname"),
        k["resource_state"].alias("resource_state"),
        "batch_seq",
        (F.col("parent_id") * F.lit(1000) + F.col("pos")).alias("row_seq"),
    )


def _struct_sql(cols: Sequence[str]) -> str:
    return "struct(" + ", ".join(f"`{c}`" for c in cols) + ")"


def keyed_merge(
    records: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = tuple(ORDER_COLS),
    among: Callable[[DataFrame], DataFrame] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Keep one record per key: the one with the greatest ``order`` tuple.

    Keys are separate columns compared null-safely (grouping treats NULLs as
    equal), never a joined string, so ('A_B', 'C') and ('A', 'B_C') stay apart.

    Records of fixed-width columns are merged at once. Others in two phases: the
    greatest order per key from the narrow columns alone, then the winners' wide
    rows by key and order. Key and order together are a record's own, so a hot key
    spreads over all tasks, and full records are neither sorted nor aggregated.
    Of records that tie in key and order one is kept.

    ``among`` gets one row per key and returns those that are wanted (it looks at
    the keys alone), before wide rows are moved. Where no two records tie
    (``unique``), nothing is counted and wide rows are shuffled once.
    """
    payload = [f for f in records.schema if f.name not in keys]
    if all(isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)) for f in payload):
        merged = _merged_at_once(records, keys, order)
        return among(merged).select(*records.columns) if among else merged
    at = [*keys, *order]
    if unique:
        best = records.groupBy(*keys).agg(F.expr(f"max({_struct_sql(order)})").alias("merge_best"))
    else:
        held = records.groupBy(*at).agg(F.count(F.lit(1)).alias("merge_n"))
        best = held.groupBy(*keys).agg(F.expr(f"max({_struct_sql([*order, 'merge_n'])})").alias("merge_best"))
    best = best.selectExpr(*[f"`{k}`" for k in keys], "merge_best.*")
    best = among(best) if among else best
    if unique:
        own = F.expr(_struct_sql(at)).alias("merge_at")  # NULLs within a struct are equal
        best = best.select(own).hint("shuffle_hash")
        return records.withColumn("merge_at", own).join(best, "merge_at").select(*records.columns)
    best = best.hint("shuffle_hash").alias("b")
    same = [F.col(f"r.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in at]
    won = records.alias("r").join(best, same).select("r.*", "b.merge_n")
    alone, tied = (won.where(cond).drop("merge_n") for cond in ("merge_n = 1", "merge_n > 1"))
    return alone.unionByName(_merged_at_once(tied, keys, order))


def _merged_at_once(records: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    payload = [c for c in records.columns if c not in keys]
    best = F.expr(f"max_by({_struct_sql(payload)}, {_struct_sql(order)})").alias("r")
    return records.groupBy(*keys).agg(best).selectExpr(
        *[f"`{c}`" for c in keys], *[f"r.`{c}` AS `{c}`" for c in payload]
    ).select(*records.columns)


def key_ranges(batch: DataFrame, key: str = BRONZE_KEY, parts: int = 64) -> list[tuple[int, int]]:
    """At most ``parts`` ranges (least, greatest) that hold every key of a batch.

    The batch's span is cut into equal parts, and each part shrinks to the keys in
    it: keys that lie close together give short ranges, a part with one key gives
    that key. Two narrow passes over the batch; a bounded list on the driver.
    """
    keys = batch.where(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    span = keys.agg(F.min("k").alias("lo"), F.max("k").alias("hi")).first()
    if span["lo"] is None:
        return []
    width = (span["hi"] - span["lo"]) // parts + 1
    part = F.expr(f"(CAST(k AS DECIMAL(20,0)) - {span['lo']}BD) DIV {width}BD")
    return sorted((r["lo"], r["hi"]) for r in keys.groupBy(part.alias("part")).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect())


def within(table: DataFrame, ranges: Sequence[tuple[int, int]], key: str = BRONZE_KEY) -> DataFrame:
    """Rows whose key lies in one of the ranges. The condition reaches the scan:
    row groups and pages by their statistics, single keys by Bloom filters."""
    held = [F.col(key) == F.lit(lo) if lo == hi else F.col(key).between(F.lit(lo), F.lit(hi)) for lo, hi in ranges]
    return table.where(reduce(Column.__or__, held)) if held else table.limit(0)


def new_keys_only(
    batch: DataFrame, history: DataFrame, key: str = BRONZE_KEY, ranges: Sequence[tuple[int, int]] | None = None
) -> DataFrame:
    """``WHERE key NOT IN (SELECT key FROM history)`` without the NULL trap.

    SQL ``NOT IN`` returns nothing once the history holds a NULL key and plans
    as a null-aware anti join that must broadcast the whole history. NULL keys
    are dropped on both sides instead, and the rest is one shuffled anti join on
    the history's key column; adaptive execution broadcasts a side only after
    its shuffle has measured it, and splits a skewed key.

    With the batch's ``key_ranges``, only the part of the history that can hold a
    key of the batch is read.
    """
    batch = batch.where(F.col(key).isNotNull())
    hist = history.select(key).where(F.col(key).isNotNull())
    return batch.join(hist if ranges is None else within(hist, ranges, key), key, "left_anti")


def pk_violations(table: DataFrame, key: str = BRONZE_KEY) -> DataFrame:
    """Keys that occur more than once (Spark enforces no primary key)."""
    return (
        table.groupBy(key)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > F.lit(1))
    )


# The activity types the athlete totals are kept for.
TOTAL_TYPES = [("Run", "run"), ("Ride", "ride"), ("Swim", "swim")]
TOTAL_FIELDS = ("count", "distance", "moving_time", "elevation_gain")


def athlete_totals(raw: DataFrame, owner: Column | None = None) -> DataFrame:
    """Per-athlete all-time totals by activity type (the athlete-stats record).

    One conditional aggregate per (type, measure): a single hash aggregate
    with a partial step, so an athlete owning a third of all activities is
    reduced map-side before the shuffle. Totals are sums, so a new batch's
    totals merge into the previous ones by adding (``merge_totals``).
    """
    kind = F.col("type")
    aggs = []
    for value, prefix in TOTAL_TYPES:
        hit = kind == F.lit(value)
        aggs += [
            F.sum(F.when(hit, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(f"{prefix}_count"),
            F.sum(F.when(hit, F.col("distance")).otherwise(F.lit(0.0))).alias(f"{prefix}_distance"),
            F.sum(F.when(hit, F.col("moving_time")).otherwise(F.lit(0))).cast("bigint").alias(f"{prefix}_moving_time"),
            F.sum(F.when(hit, F.col("total_elevation_gain")).otherwise(F.lit(0.0))).alias(f"{prefix}_elevation_gain"),
        ]
    owner = F.col("athlete.id") if owner is None else owner
    return raw.groupBy(owner.alias("athlete_id")).agg(*aggs)


def merge_totals(previous: DataFrame, batch_totals: DataFrame) -> DataFrame:
    """Add a batch's totals to the previous ones (exact: sums are mergeable)."""
    cols = [c for c in batch_totals.columns if c != "athlete_id"]
    return (
        previous.unionByName(batch_totals)
        .groupBy("athlete_id")
        .agg(*[F.sum(c).cast(batch_totals.schema[c].dataType).alias(c) for c in cols])
    )
