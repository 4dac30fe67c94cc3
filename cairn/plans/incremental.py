"""Incremental maintenance of silver, gold and the star schema.

A run appends only new keys to bronze. Every silver row, every gold summary
or training-load row and every fact row depends on its own bronze row only,
so those tables are appended per batch as well. The other tables are merged
exactly:

* weekly / monthly rollups: each batch appends its own partial states (sums,
  counts, least and greatest, one row a period it touches), and the rollup is
  merged from all states; late rows over any number of periods cost their batch;
* top-10 paces: top-10 of (previous top-10 + the batch), exact because the
  order is total;
* date and activity-type dimensions: only members not seen yet are appended;
* athlete names are re-joined for all owners, so a renamed athlete is not kept
  twice (the one dimension that is written whole).

A run reads of the history's keys only what can hold a key of its batch (the
batch's key ranges against the commits' ranges, then the scan's statistics); the
rest of its cost follows the batch, the states and the folder listings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.operators import dims, gold
from cairn.plans.lake import Lake
from cairn.schemas import ORDER_COLS


def _previous(lake: Lake, layer: str, table: str) -> DataFrame | None:
    return lake.read(layer, table) if lake.versions(layer, table) else None


def append_states(lake: Lake, table: str, batch_fact: DataFrame, batch_id: int) -> tuple[str, int]:
    """The period states of one batch, appended: a row for each period in it."""
    return lake.append_batch(gold.period_state(batch_fact, table), "state", table, batch_id)


def merged_periods(lake: Lake, table: str) -> DataFrame:
    """A period rollup from all batches' states: batches times periods short rows
    at most, whichever periods the last batch touched; the fact is not read."""
    return gold.period_stats_from_states(lake.read_table("state", table), table)


def refresh_top_paces(lake: Lake, new_fact: DataFrame) -> DataFrame:
    """Top-k of the batch (a per-task top-k, no shuffle of the batch), merged
    with the previous top-k; ``distinct`` keeps a retried batch from
    counting its rows twice."""
    batch_top = gold.pb_efforts(new_fact)
    previous = _previous(lake, "gold", "gold_pb_efforts")
    if previous is None:
        return batch_top
    return gold.pb_efforts(previous.unionByName(batch_top).distinct())


# Keys of the dimensions that only gain members.
MEMBER_KEYS = {"dim_date": ["date_id"], "dim_activity_type": ["athlete_id", "activity_type_id"]}


def new_members(lake: Lake, table: str, batch_members: DataFrame, batch_id: int) -> DataFrame:
    """Members of a batch that the dimension lacks (NULL keys are members too).
    The batch's own earlier try doesn't count, so a retry appends them again."""
    there = [b for b in lake.batches("gold", table) if b != batch_id]
    if not there:
        return batch_members
    have = lake.read_some("gold", table, there).select(*[F.col(k).alias(f"have_{k}") for k in MEMBER_KEYS[table]])
    same = [F.col(k).eqNullSafe(F.col(f"have_{k}")) for k in MEMBER_KEYS[table]]
    return batch_members.join(have, same, "left_anti")


def refresh_athletes(lake: Lake, owned_fact: DataFrame, athletes: DataFrame) -> DataFrame:
    owners = dims.owner_ids(owned_fact, None)
    previous = _previous(lake, "gold", "dim_athlete")
    if previous is not None:
        owners = owners.unionByName(previous.select("athlete_id")).distinct()
    return dims.name_owners(owners, athletes)


# --------------------------------------------------------------- merge on read
def merge_on_read(lake: Lake, layer: str, table: str, keys, order=tuple(ORDER_COLS)) -> DataFrame:
    """Merged view of an append-only keyed table: the newest compacted base
    ``v=<n>`` (the merge of batches 1..n), plus only the batches after it,
    merged by key on their order columns."""
    from cairn.operators import ingest

    bases = lake.versions(layer, table)
    later = [b for b in lake.batches(layer, table) if not bases or b > bases[-1]]
    root = lake.table_path(layer, table)
    parts = []
    if bases:
        parts.append(lake.read_version(layer, table, bases[-1]))
    if later:
        parts.append(lake.spark.read.option("basePath", root).parquet(*[f"{root}/batch={b}" for b in later]).drop("batch"))
    if not parts:
        raise FileNotFoundError(f"{layer}/{table} has no committed data")
    union = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return ingest.keyed_merge(union, list(keys), list(order))


def compact(lake: Lake, layer: str, table: str, keys, order=tuple(ORDER_COLS)) -> int | None:
    """Write the merged view as base ``v=<last batch id>``, so later reads
    merge one base and the batches after it instead of every batch.

    Never overwrites what it reads: a base for the newest batch already
    exists -> nothing to do. Returns the new base id (or None).
    """
    batches = lake.batches(layer, table)
    bases = lake.versions(layer, table)
    if not batches or (bases and bases[-1] >= batches[-1]):
        return None
    merged = merge_on_read(lake, layer, table, keys, order)
    lake.write_version(merged, layer, table, version=batches[-1])
    return batches[-1]
