"""The lake's layout: commits, key ranges, audits, counts, states, members, schemes."""

import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import ingest, quality
from cairn.plans import incremental
from cairn.plans.lake import Lake, Location
from cairn.schemas import BRONZE_ACTIVITIES, BRONZE_KEY

KEYED = "activity_id long, v string"


def keyed(spark, ids):
    return spark.createDataFrame([(i, f"v{i}") for i in ids], KEYED)


def scan_metrics(df):
    """(files, rows) that the plan's Parquet scans read, after running it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    files = rows = 0
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if "Scan parquet" in node.nodeName():
            files += node.metrics().apply("numFiles").value()
            rows += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return files, rows


# ---------------------------------------------------------------- key ranges
@pytest.mark.parametrize("seed", range(4))
def test_key_ranges_hold_every_key(spark, seed):
    rng = random.Random(seed)
    keys = [[], [7], [-(2**63), 2**63 - 1, 0], [rng.randint(-(10**12), 10**12) for _ in range(500)]][seed]
    ranges = ingest.key_ranges(keyed(spark, [*keys, None]), parts=16)
    assert len(ranges) <= 16 and all(any(lo <= k <= hi for lo, hi in ranges) for k in keys)
    assert all(lo in keys and hi in keys for lo, hi in ranges)
    assert ranges == sorted(ranges) and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    table = keyed(spark, [*keys, 10**15, None])
    assert sorted(r[0] for r in ingest.within(table, ranges).collect()) == sorted(keys)


def test_the_anti_join_reads_what_the_batch_can_meet(spark, scratch):
    lake = Lake(spark, f"{scratch}/lake")
    for b in range(1, 9):
        lake.append_batch(keyed(spark, range(b * 10_000, b * 10_000 + 2000)), "bronze", "t", b, key="activity_id")
    batch = keyed(spark, [30_005, 30_010, 39_999, None])
    ranges = ingest.key_ranges(batch)
    assert lake.overlapping("bronze", "t", lake.batches("bronze", "t"), ranges) == [3]
    history = lake.read_batches("bronze", "t", batch.schema, ranges=ranges)
    assert [r[0] for r in ingest.new_keys_only(batch, history, ranges=ranges).collect()] == [39_999]
    whole = keyed(spark, range(1, 100_000, 7))  # a batch over all of the history
    got = ingest.new_keys_only(whole, lake.read_batches("bronze", "t", batch.schema, ranges=ingest.key_ranges(whole)), ranges=ingest.key_ranges(whole))
    assert got.count() == sum(not 0 <= i % 10_000 < 2000 or not 10_000 <= i < 90_000 for i in range(1, 100_000, 7))


def test_single_keys_are_refused_by_bloom_filters(spark, scratch):
    """A key inside the range of every file that is in none of them: no row is read."""
    lake = Lake(spark, f"{scratch}/lake")
    lake.append_batch(spark.range(0, 40_000, 2).selectExpr("id AS activity_id", "'x' AS v").coalesce(1), "bronze", "t", 1, key="activity_id")
    table = lake.read_some("bronze", "t", [1])
    assert scan_metrics(ingest.within(table, [(20_000, 20_000)]))[1] > 0
    assert scan_metrics(ingest.within(table, [(20_001, 20_001)]))[1] == 0
    ranged = ingest.within(table, [(100, 200)])
    assert "GreaterThanOrEqual(activity_id,100), LessThanOrEqual(activity_id,200)]" in ranged._jdf.queryExecution().executedPlan().toString()


def test_a_backlog_costs_its_files(spark, scratch, monkeypatch):
    """Files with keys of their own: no micro-batch opens an earlier batch."""
    from cairn.schemas import RAW_ACTIVITY_LANDED
    from cairn.streaming.bronze_stream import ingest_bronze_stream, read_bronze

    for k in range(6):
        rows = [tuple({"id": k * 100 + j, "batch_seq": 1, "row_seq": j}.get(f.name) for f in RAW_ACTIVITY_LANDED) for j in range(5)]
        spark.createDataFrame(rows, RAW_ACTIVITY_LANDED).coalesce(1).write.mode("append").json(f"{scratch}/landing")
    lake, opened = Lake(spark, f"{scratch}/lake"), []
    real = lake.overlapping
    monkeypatch.setattr(lake, "overlapping", lambda *a: opened.append(len(real(*a))) or real(*a))
    ingest_bronze_stream(spark, f"{scratch}/landing", lake, f"{scratch}/ckpt", max_files_per_trigger=1)
    assert len(opened) == 6 and sum(opened) == 0
    assert read_bronze(lake).count() == 30
    ingest_bronze_stream(spark, f"{scratch}/landing", lake, f"{scratch}/ckpt2", max_files_per_trigger=1)
    assert opened[6:] and max(opened[6:]) <= 2 and read_bronze(lake).count() == 30  # each meets its own rows (and nothing is new)


# ---------------------------------------------------------------- commits
def test_a_refused_batch_is_never_readable(spark, scratch):
    lake = Lake(spark, f"{scratch}/lake")
    unique = lambda rows: quality.assert_new_and_unique(rows, None, BRONZE_KEY)
    with pytest.raises(ValueError, match="duplicate key"):
        lake.append_batch(keyed(spark, [1, 2, 2]), "bronze", "t", 1, key=BRONZE_KEY, audit=unique)
    assert lake.batches("bronze", "t") == [] and not lake.exists("bronze", "t")
    lake.append_batch(keyed(spark, [1, 2]), "bronze", "t", 1, key=BRONZE_KEY, audit=unique)
    history = lake.read_some("bronze", "t", [1])
    for bad, why in (([2, 3], "in the table already"), ([3, None], "null key"), ([3, 3], "duplicate key")):
        with pytest.raises(ValueError, match=why):
            lake.append_batch(keyed(spark, bad), "bronze", "t", 2, audit=lambda rows: quality.assert_new_and_unique(rows, history, BRONZE_KEY))
        assert lake.batches("bronze", "t") == [1]
        assert sorted(r[0] for r in lake.read_table("bronze", "t").collect()) == [1, 2]
    lake.append_batch(keyed(spark, [3]), "bronze", "t", 2, audit=lambda rows: quality.assert_new_and_unique(rows, history, BRONZE_KEY))
    assert lake.read_table("bronze", "t").count() == 3


def test_a_retry_that_fails_hides_the_old_rows_too(spark, scratch):
    """The folder of a batch being written again holds neither try for certain."""
    lake = Lake(spark, f"{scratch}/lake")
    lake.append_batch(keyed(spark, [1]), "bronze", "t", 1)

    def refuse(rows):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        lake.append_batch(keyed(spark, [1, 2]), "bronze", "t", 1, audit=refuse)
    assert Lake(spark, f"{scratch}/lake").batches("bronze", "t") == []
    lake.append_batch(keyed(spark, [1, 2]), "bronze", "t", 1)
    assert Lake(spark, f"{scratch}/lake").rows("bronze", "t") == 2


def test_a_lost_overwrite_keeps_the_base(spark, scratch):
    """The compacted base goes only when the batch that replaces its rows is whole."""
    lake = Lake(spark, f"{scratch}/lake")
    lake.append_batch(keyed(spark, [1]), "raw", "t", 1)
    lake.write_version(keyed(spark, [1]), "raw", "t", version=1)

    def refuse(rows):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        lake.append_batch(keyed(spark, [5]), "raw", "t", 1, audit=refuse)
    assert [r[0] for r in lake.read_table("raw", "t").collect()] == [1]
    lake.append_batch(keyed(spark, [5]), "raw", "t", 1)
    assert [r[0] for r in lake.read_table("raw", "t").collect()] == [5]


def test_counts_come_from_the_writes(spark, scratch):
    """Observed rows, zstd files, and no job over data for the counts."""
    lake = Lake(spark, f"{scratch}/lake")
    path, n = lake.write_version(keyed(spark, range(10)), "raw", "a")
    assert n == 10
    import pyarrow.parquet as pq
    import glob

    files = glob.glob(f"{path}/*.parquet")
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    for b in (1, 2, 3):
        lake.append_batch(keyed(spark, range(b)), "bronze", "b", b)
    counts = quality.written_counts(spark, lake, [("raw", "a", "bronze", "b")])
    assert [tuple(r) for r in counts.collect()] == [("a", "b", 10, 6)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counts", "counts only")
    try:
        assert lake.rows("bronze", "b") == 6
        assert not tracker.getJobIdsForGroup("counts")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert Lake(spark, f"{scratch}/lake").rows("bronze", "b") == 6  # another process reads the commit files
    with pytest.raises(ValueError, match="has 6 rows"):
        quality.validate_counts(counts, equal=True)


# ---------------------------------------------------------------- tables kept by batch
def test_states_of_late_rows_merge_exactly(spark, scratch, monkeypatch):
    """Batches over all periods, a retry, and no read of the fact."""
    from cairn.operators import gold
    from test_pipeline import _same_rows

    rng = random.Random(8)

    def fact(n):
        rows = [
            (rng.choice([None, f"{rng.randint(2019, 2024)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} 10:00:00"]), *[rng.choice([None, rng.uniform(0, 50)]) for _ in range(6)], *[rng.choice([None, rng.randint(0, 9)]) for _ in range(3)])
            for _ in range(n)
        ]
        names = "distance_km double, moving_time_min double, pace_min_per_km double, average_heartrate double, max_heartrate double, total_elevation_m double, kudos_count long, comment_count long, pr_count long"
        return spark.createDataFrame(rows, f"start string, {names}").withColumn("start_date_utc", F.col("start").cast("timestamp_ntz"))

    parts = [fact(n) for n in (200, 1, 0, 150)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    lake = Lake(spark, f"{scratch}/lake")
    for table in gold.PERIODS:
        incremental.append_states(lake, table, parts[0].limit(3), 1)
        for b, part in enumerate(parts, 1):
            incremental.append_states(lake, table, part, b)
        assert _same_rows(incremental.merged_periods(lake, table), gold.period_stats(whole, table)), table


def test_dimensions_append_members_not_seen_yet(spark, scratch):
    lake = Lake(spark, f"{scratch}/lake")
    schema = "athlete_id long, activity_type_id string, sport_category string"
    batches = [[(1, "Run", "Cardio"), (None, "Run", "Cardio")], [(1, "Run", "Cardio"), (1, "Yoga", "Flexibility"), (None, "Run", "Cardio")], [(2, "Run", "Cardio")]]
    wrote = []
    for b, rows in enumerate(batches, 1):
        for _ in range(2):  # and once more, as a retry
            members = incremental.new_members(lake, "dim_activity_type", spark.createDataFrame(rows, schema), b)
            wrote.append(lake.append_batch(members, "gold", "dim_activity_type", b)[1])
    assert wrote == [2, 2, 1, 1, 1, 1]
    got = [tuple(r) for r in lake.read_table("gold", "dim_activity_type").collect()]
    assert sorted(got, key=str) == sorted({r for rows in batches for r in rows}, key=str)


# ---------------------------------------------------------------- object stores
def test_layers_on_another_scheme_with_scoped_access(spark, scratch):
    """Access to a second file system goes as options of the layer that lives
    there: it is on no session setting, and other layers don't have it."""
    import os

    os.makedirs(f"{scratch}/far")
    access = {"fs.viewfs.mounttable.bronze-store.link./in": f"file://{scratch}/far"}
    lake = Lake(spark, f"{scratch}/lake", layers={"bronze": Location("viewfs://bronze-store/in/bronze", access)})
    for b in (1, 2):
        lake.append_batch(keyed(spark, range(b * 10, b * 10 + 5)), "bronze", "t", b, key="activity_id")
    lake.write_version(lake.read_table("bronze", "t"), "silver", "t")
    again = Lake(spark, f"{scratch}/lake", layers={"bronze": Location("viewfs://bronze-store/in/bronze", access)})
    assert again.batches("bronze", "t") == [1, 2] and again.rows("bronze", "t") == 10
    assert again.overlapping("bronze", "t", [1, 2], [(21, 21)]) == [2]
    assert again.read("silver", "t").count() == 10
    assert sorted(os.listdir(f"{scratch}/far/bronze/t")) == ["_commits", "batch=1", "batch=2"]
    assert os.path.isdir(f"{scratch}/lake/silver/t") and not os.path.exists(f"{scratch}/lake/bronze")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assert all(conf.get(name) is None and spark.conf.get(name, None) is None for name in access)


def test_first_run_schema_is_the_declared_one(spark, scratch):
    empty = Lake(spark, f"{scratch}/none").read_batches("bronze", "bronze_activities", BRONZE_ACTIVITIES, ranges=[(1, 2)])
    assert empty.schema == BRONZE_ACTIVITIES and empty.isEmpty()
