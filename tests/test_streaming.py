"""Streaming ingest: exactly-once effect across reruns and retries."""

import tempfile

from pyspark.sql import functions as F

from cairn.operators import bronze, ingest
from cairn.plans.lake import Lake
from cairn.schemas import MERGE_KEYS, RAW_ACTIVITY_LANDED
from cairn.session import shared_dir
from cairn.sources import fixtures, landing
from cairn.streaming import bronze_stream
from cairn.streaming.bronze_stream import ingest_bronze_stream, read_bronze
from cairn.streaming.merge_stream import merge_stream, merged
from conftest import SF_SMALL


def test_bronze_stream_rerun_adds_nothing(spark):
    root = tempfile.mkdtemp(prefix="s-", dir=shared_dir(spark))
    landing.write_activity_batches(spark, SF_SMALL, f"{root}/landing")
    lake = Lake(spark, f"{root}/lake")
    # small triggers: several micro-batches, each anti-joined to the ones before
    ingest_bronze_stream(spark, f"{root}/landing/activities/*", lake, f"{root}/ckpt", max_files_per_trigger=1)
    first = read_bronze(lake)
    assert len(lake.batches("bronze", "bronze_activities")) > 1
    n = first.count()
    assert n == fixtures.read_table(spark, SF_SMALL, "orders").count()
    assert first.groupBy("activity_id").count().where("count > 1").count() == 0
    # same checkpoint: no file is new, nothing is appended
    ingest_bronze_stream(spark, f"{root}/landing/activities/*", lake, f"{root}/ckpt")
    assert read_bronze(lake).count() == n
    # a fresh checkpoint re-reads every file; the anti join still adds nothing
    ingest_bronze_stream(spark, f"{root}/landing/activities/*", lake, f"{root}/ckpt2")
    assert read_bronze(lake).count() == n


def test_merge_stream_equals_batch_merge(spark):
    root = tempfile.mkdtemp(prefix="m-", dir=shared_dir(spark))
    landing.write_activity_batches(spark, SF_SMALL, f"{root}/landing")
    lake = Lake(spark, f"{root}/lake")
    merge_stream(spark, f"{root}/landing/activities/*", RAW_ACTIVITY_LANDED, MERGE_KEYS["activities"],
                 lake, "raw_activities", f"{root}/ckpt", max_files_per_trigger=1)
    assert len(lake.batches("raw", "raw_activities")) > 1
    streamed = merged(lake, "raw_activities", MERGE_KEYS["activities"]).select("id", "kudos_count", "batch_seq")
    batch = ingest.keyed_merge(fixtures.activity_batches(spark, SF_SMALL), ["id"]).select("id", "kudos_count", "batch_seq")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    # the re-fetched records carry the later kudo count
    assert streamed.where(F.col("batch_seq") == 2).count() > 0


def test_bronze_stream_recovers_from_a_failed_micro_batch(spark):
    """The batch is written, then the micro-batch dies before the stream
    commits it: the restarted stream replays the epoch, which overwrites its
    own directory and is compared with history excluding itself."""
    import pytest

    root = tempfile.mkdtemp(prefix="f-", dir=shared_dir(spark))
    landing.write_activity_batches(spark, SF_SMALL, f"{root}/landing")
    lake = Lake(spark, f"{root}/lake")
    real_append = lake.append_batch
    calls = {"n": 0}

    def append_then_fail(*args, **kwargs):
        out = real_append(*args, **kwargs)
        calls["n"] += 1
        if calls["n"] == 2:  # the second micro-batch is lost after its write
            raise RuntimeError("executor lost")
        return out

    lake.append_batch = append_then_fail
    with pytest.raises(Exception):
        ingest_bronze_stream(spark, f"{root}/landing/activities/*", lake, f"{root}/ckpt", max_files_per_trigger=1)
    lake.append_batch = real_append
    ingest_bronze_stream(spark, f"{root}/landing/activities/*", lake, f"{root}/ckpt", max_files_per_trigger=1)
    bronze_rows = read_bronze(lake)
    assert bronze_rows.count() == fixtures.read_table(spark, SF_SMALL, "orders").count()
    assert bronze_rows.groupBy("activity_id").count().where("count > 1").count() == 0


def test_streams_over_many_cut_files(spark, monkeypatch):
    """Landed files end after so many records, so a long fetch is several
    micro-batches of bounded size, with the same rows in the end."""
    import glob

    root = tempfile.mkdtemp(prefix="c-", dir=shared_dir(spark))
    write = landing.write_ndjson
    monkeypatch.setattr(landing, "write_ndjson", lambda df, path: write(df, path, per_file=200))
    landing.write_activity_batches(spark, SF_SMALL, f"{root}/landing")
    landed = spark.read.schema(RAW_ACTIVITY_LANDED).json(f"{root}/landing/activities/*")
    n = fixtures.read_table(spark, SF_SMALL, "orders").count()
    sizes = [r["count"] for r in landed.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert max(sizes) <= 200 and sum(sizes) == fixtures.activity_batches(spark, SF_SMALL).count() > n
    assert len(glob.glob(f"{root}/landing/activities/*/part-*.json.gz")) >= len(sizes)
    lake = Lake(spark, f"{root}/lake")
    ingest_bronze_stream(spark, f"{root}/landing/activities/*", lake, f"{root}/bronze", max_files_per_trigger=4)
    assert len(lake.batches("bronze", "bronze_activities")) > 1
    want = bronze.activities(fixtures.raw_activities(spark, SF_SMALL))
    assert read_bronze(lake).count() == n and read_bronze(lake).exceptAll(want).isEmpty()
    merge_stream(spark, f"{root}/landing/activities/*", RAW_ACTIVITY_LANDED, MERGE_KEYS["activities"], lake, "raw_activities", f"{root}/merge", max_files_per_trigger=4)
    streamed = merged(lake, "raw_activities", MERGE_KEYS["activities"])
    batch = ingest.keyed_merge(fixtures.activity_batches(spark, SF_SMALL), ["id"]).select(*streamed.columns)
    assert streamed.count() == n and streamed.exceptAll(batch).isEmpty()


def test_bronze_stream_moves_the_table_s_columns_once(spark, monkeypatch):
    """Of a micro-batch only the published columns are shuffled, in one exchange;
    the others of its plan hold keys and order alone."""
    import re

    root = tempfile.mkdtemp(prefix="w-", dir=shared_dir(spark))
    landing.write_activity_batches(spark, SF_SMALL, f"{root}/landing")
    lake = Lake(spark, f"{root}/lake")
    real_append, widths = lake.append_batch, []

    def seen(df, *args, **kwargs):
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        widths.append([int(n) for n in re.findall(r"\) Exchange *\nInput \[(\d+)\]", plan)])
        return real_append(df, *args, **kwargs)

    monkeypatch.setattr(lake, "append_batch", seen)
    for run, rows in (("first", 250_000), ("again", 250_000), ("many", 100)):  # without and with a history, and in more parts
        monkeypatch.setattr(bronze_stream, "SORTED_ROWS", rows, raising=False)
        ingest_bronze_stream(spark, f"{root}/landing/activities/*", lake, f"{root}/{run}")
    assert len(widths) == 3 and spark.conf.get("spark.sql.shuffle.partitions") == "8"
    for held in widths:
        assert sorted(held)[:-1] == [n for n in sorted(held) if n <= 6] and 23 <= max(held) <= 27


def test_bronze_stream_over_ties_nulls_and_history(spark):
    """A key's last record wins, one of those that tie; null keys and keys of the
    history add nothing."""
    import json
    import os

    root = tempfile.mkdtemp(prefix="t-", dir=shared_dir(spark))
    os.makedirs(f"{root}/in")

    def land(name, rows):
        with open(f"{root}/in/{name}", "w") as out:
            out.writelines(json.dumps(dict(zip(("id", "name", "batch_seq", "row_seq"), r))) + "\n" for r in rows)

    lake = Lake(spark, f"{root}/lake")
    land("a.json", [(1, "one", 1, 1), (2, "old", 1, 2), (None, "lost", 1, 3)] + [(7, f"n{k}", 1, k) for k in range(500)])
    land("b.json", [(2, "new", 2, 1), (3, "tie", 2, 2), (3, "tie", 2, 2), (4, "x", 2, 5), (4, "y", 2, 5), (5, "late", 2, None), (5, "last", 2, 0)])
    ingest_bronze_stream(spark, f"{root}/in", lake, f"{root}/ckpt")
    got = {r["activity_id"]: r["name"] for r in read_bronze(lake).collect()}
    assert read_bronze(lake).count() == len(got) == 6
    assert got.pop(4) in ("x", "y") and got == {1: "one", 2: "new", 3: "tie", 5: "last", 7: "n499"}
    land("c.json", [(2, "newer", 3, 1), (6, "six", 3, 2), (None, "lost", 3, 3), (6, "six again", 3, 4)])
    ingest_bronze_stream(spark, f"{root}/in", lake, f"{root}/ckpt")
    later = {r["activity_id"]: r["name"] for r in read_bronze(lake).collect()}
    assert later[2] == "new" and later[6] == "six again" and len(later) == read_bronze(lake).count() == 7


def test_merge_among_wanted_keys(spark):
    """Keys that are not wanted are left out, with and without ties, for wide
    records and those of fixed width."""
    rows = spark.range(0, 4000, 1, 6).selectExpr("id % 300 AS k", "1L AS batch_seq", "id AS row_seq", "concat('r', id) AS text", "id * 2 AS twice")
    wanted = lambda keys: keys.where("k % 3 = 0")
    for cols in (["k", "batch_seq", "row_seq", "text"], ["k", "batch_seq", "row_seq", "twice"]):
        records = rows.select(*cols)
        want = sorted(map(tuple, ingest.keyed_merge(records, ["k"]).where("k % 3 = 0").collect()))
        assert len(want) == 100
        for unique in (False, True):
            assert sorted(map(tuple, ingest.keyed_merge(records, ["k"], among=wanted, unique=unique).collect())) == want
        tied = records.unionByName(records)
        assert sorted(map(tuple, ingest.keyed_merge(tied, ["k"], among=wanted).collect())) == want
