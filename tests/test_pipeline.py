"""End-to-end runs of the scheduled pipeline over two landed fetches."""

import os

import pytest
from pyspark.sql import functions as F

from cairn.plans import pipeline
from cairn.plans.lake import Lake
from cairn.plans.publish import GOLD_TABLES, listing
from cairn.schemas import RAW_ACTIVITY
from cairn.sources import fixtures, landing
from cairn.sources.files import read_landed
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def two_runs(spark, tmp_path_factory):
    from cairn.session import shared_dir
    import tempfile

    root = tempfile.mkdtemp(prefix="pipe-", dir=shared_dir(spark))
    paths = landing.write_landings(spark, SF_SMALL, f"{root}/landing")  # indented JSON arrays, as the client saves them
    lake = Lake(spark, f"{root}/lake")
    first = pipeline.run(spark, lake, paths[0], batch_id=1)
    bronze_v1 = sorted(map(tuple, lake.read_batches("bronze", "bronze_activities", _schema()).collect()))
    second = pipeline.run(spark, lake, paths[1], batch_id=2)
    return {"lake": lake, "paths": paths, "first": first, "second": second, "bronze_v1": bronze_v1}


def _schema():
    from cairn.schemas import BRONZE_ACTIVITIES

    return BRONZE_ACTIVITIES


def test_first_run_loads_everything_from_fetch_one(spark, two_runs):
    landed = fixtures.activity_batches(spark, SF_SMALL)
    n1 = landed.where(F.col("batch_seq") == 1).count()
    assert two_runs["first"]["bronze_activities"] == n1
    assert two_runs["first"]["silver_activity_fact"] == n1


def test_second_run_appends_only_records_newer_than_watermark(spark, two_runs):
    lake = two_runs["lake"]
    orders = fixtures.read_table(spark, SF_SMALL, "orders").count()
    bronze_all = lake.read_batches("bronze", "bronze_activities", _schema())
    assert bronze_all.count() == orders  # fetch 1 + the part of fetch 2 past the watermark
    assert bronze_all.groupBy("activity_id").count().where("count > 1").count() == 0
    assert lake.read_table("silver", "silver_activity_fact").count() == orders


def test_history_is_never_rewritten(spark, two_runs):
    lake = two_runs["lake"]
    batch1 = spark.read.parquet(f"{lake.table_path('bronze', 'bronze_activities')}/batch=1").select(*_schema().names)
    assert sorted(map(tuple, batch1.collect())) == two_runs["bronze_v1"]


def test_rerun_of_a_batch_adds_nothing(spark, two_runs):
    lake = two_runs["lake"]
    before = lake.read_batches("bronze", "bronze_activities", _schema()).count()
    counts = pipeline.run(spark, lake, two_runs["paths"][1], batch_id=3, do_publish=False)
    assert counts == {}  # nothing newer than the watermark: the gate stops the run
    assert lake.read_batches("bronze", "bronze_activities", _schema()).count() == before


def test_retry_of_same_batch_id_is_idempotent(spark, two_runs, tmp_path):
    from cairn.operators import bronze, ingest

    lake = Lake(spark, str(tmp_path / "lake"))
    landed = read_landed(spark, f"{two_runs['paths'][0]}/activities", RAW_ACTIVITY, 1)
    for _ in range(2):  # the same batch id written twice (a retried task/job)
        hist = lake.read_batches("bronze", "bronze_activities", _schema(), exclude=1)
        lake.append_batch(ingest.new_keys_only(bronze.activities(landed), hist), "bronze", "bronze_activities", 1)
    assert lake.read_batches("bronze", "bronze_activities", _schema()).count() == landed.count()


def test_weekly_counts_cover_fact(spark, two_runs):
    lake = two_runs["lake"]
    weekly = lake.read("gold", "gold_weekly_stats").agg(F.sum("activity_count")).first()[0]
    assert weekly == lake.read_table("silver", "silver_activity_fact").count()


def test_publish_lists_all_gold_tables(spark, two_runs):
    names = [r.table_name for r in listing(spark).collect()]
    assert set(f"{t}_table" for t in GOLD_TABLES) <= set(names)
    published = spark.table("gold.fact_activities_table")
    assert published.count() == two_runs["lake"].read_table("gold", "fact_activities").count()
    assert "batch" not in published.columns


def test_keyed_raw_merge_keeps_latest_fetch(spark, two_runs):
    raw = pipeline.raw_view(two_runs["lake"], "raw_activities")
    assert raw.groupBy("id").count().where("count > 1").count() == 0
    assert raw.where("batch_seq = 2").count() > 0


def test_full_refresh_keeps_versions(two_runs):
    lake = two_runs["lake"]
    assert lake.versions("gold", "gold_weekly_stats") == [1, 2]
    assert os.path.basename(lake.latest_path("gold", "gold_weekly_stats")) == "v=2"


def _same_rows(a, b):
    from compare import _close, rows_of

    ra, ca = rows_of(a.columns, [tuple(r) for r in a.collect()])
    rb, cb = rows_of(b.columns, [tuple(r) for r in b.collect()])
    return ca == cb and len(ra) == len(rb) and all(_close(x, y) for x, y in zip(ra, rb))


def test_incremental_tables_equal_full_recompute(spark, two_runs):
    from cairn.plans import medallion

    lake = two_runs["lake"]
    records = lake.read_table("bronze", "bronze_activity_records")
    silver = medallion.silver_tables_from_records(records)
    fact = silver["silver_activity_fact"]
    expected = dict(silver)
    expected.update(medallion.gold_tables(fact))
    expected.update(
        medallion.star_tables(fact, lake.read_table("bronze", "bronze_activities"), lake.read("raw", "raw_athlete"))
    )
    for name, df in expected.items():
        layer = "silver" if name.startswith("silver") else "gold"
        assert _same_rows(lake.read_table(layer, name), df), name


def test_retried_run_is_idempotent(spark, two_runs, tmp_path):
    """Run fetch 1 twice under the same batch id: same tables as once."""
    lake = Lake(spark, str(tmp_path / "lake"))
    path = two_runs["paths"][0]
    pipeline.run(spark, lake, path, batch_id=1, do_publish=False)
    once = {t: lake.read_table("gold", t) for t in ("gold_weekly_stats", "gold_pb_efforts", "dim_date", "fact_activities")}
    once = {t: sorted(map(tuple, df.collect())) for t, df in once.items()}
    pipeline.run(spark, lake, path, batch_id=1, do_publish=False)
    for t, rows in once.items():
        assert sorted(map(tuple, lake.read_table("gold", t).collect())) == rows, t


def test_athlete_stats_equal_totals_over_bronze(spark, two_runs):
    from cairn.operators import ingest

    lake = two_runs["lake"]
    expected = ingest.athlete_totals(lake.read_table("bronze", "bronze_activity_records"), owner=F.col("athlete_id"))
    assert _same_rows(lake.read("gold", "athlete_totals"), expected)


def test_compaction_keeps_the_merged_view(spark, two_runs, tmp_path):
    import shutil

    from cairn.plans import incremental

    src = two_runs["lake"].table_path("raw", "raw_activities")
    lake = Lake(spark, str(tmp_path / "lake"))
    shutil.copytree(src, lake.table_path("raw", "raw_activities"))
    keys = ["id"]
    before = sorted(map(tuple, incremental.merge_on_read(lake, "raw", "raw_activities", keys).drop("start_latlng", "end_latlng").collect()))
    assert incremental.compact(lake, "raw", "raw_activities", keys) == 2
    assert incremental.compact(lake, "raw", "raw_activities", keys) is None  # nothing new to fold
    after = sorted(map(tuple, incremental.merge_on_read(lake, "raw", "raw_activities", keys).drop("start_latlng", "end_latlng").collect()))
    assert after == before


def test_publish_completeness_and_key_checks(spark, two_runs):
    from cairn.operators import quality

    listed = listing(spark)
    assert quality.missing_tables(spark, listed, [f"{t}_table" for t in GOLD_TABLES]).count() == 0
    missing = quality.missing_tables(spark, listed, ["no_such_table"]).collect()
    assert [r.table_name for r in missing] == ["no_such_table"]
    bronze = two_runs["lake"].read_table("bronze", "bronze_activities")
    quality.assert_unique(bronze, "activity_id")
    with pytest.raises(ValueError):
        quality.assert_unique(bronze.unionByName(bronze.limit(1)), "activity_id")


def _equal_to_full_recompute(lake):
    from cairn.operators import ingest
    from cairn.plans import medallion

    records = lake.read_table("bronze", "bronze_activity_records")
    silver = medallion.silver_tables_from_records(records)
    fact = silver["silver_activity_fact"]
    expected = {("silver", n): df for n, df in silver.items()}
    expected |= {("gold", n): df for n, df in medallion.gold_tables(fact).items()}
    star = medallion.star_tables(fact, lake.read_table("bronze", "bronze_activities"), lake.read("raw", "raw_athlete"))
    expected |= {("gold", n): df for n, df in star.items()}
    expected[("gold", "athlete_totals")] = ingest.athlete_totals(records, owner=F.col("athlete_id"))
    for key, df in expected.items():
        assert _same_rows(lake.read_table(*key), df), key


STAGES = {
    "raw": ("cairn.plans.pipeline", "land"),
    "bronze records": ("cairn.plans.medallion", "silver_tables_from_records"),
    "silver": ("cairn.operators.quality", "validate_counts"),
    "part of gold": ("cairn.plans.incremental", "refresh_top_paces"),
    "gold": ("cairn.plans.lake.Lake", "finish"),
}


@pytest.mark.parametrize("stage", list(STAGES))
@pytest.mark.parametrize("next_id", [2, 3])
def test_failed_run_then_any_next_run_is_exact(spark, two_runs, tmp_path, monkeypatch, stage, next_id):
    """Fail run 2 at a stage, then land the same files as run 2 or run 3."""
    import importlib

    lake, paths = Lake(spark, str(tmp_path / "lake")), two_runs["paths"]
    pipeline.run(spark, lake, paths[0], batch_id=1, do_publish=False)

    def lost(*args, **kwargs):
        raise RuntimeError("driver lost")

    where, name = STAGES[stage]
    target = Lake if where.endswith(".Lake") else importlib.import_module(where)
    with monkeypatch.context() as m:
        m.setattr(target, name, lost)
        with pytest.raises(RuntimeError):
            pipeline.run(spark, lake, paths[1], batch_id=2, do_publish=False)
    pipeline.run(spark, lake, paths[1], batch_id=next_id, do_publish=False)
    assert lake.read_table("bronze", "bronze_activity_records").count() == fixtures.read_table(spark, SF_SMALL, "orders").count()
    assert lake.finished()[1] >= {1, next_id}
    _equal_to_full_recompute(lake)
    assert pipeline.run(spark, lake, paths[1], batch_id=next_id + 1, do_publish=False) == {}


def test_counts_that_differ_stop_the_run(spark):
    from cairn.operators import quality

    hops = quality.layer_counts([("a", spark.range(3), "b", spark.range(2))])
    quality.validate_counts(hops)
    with pytest.raises(ValueError, match="2 rows"):
        quality.validate_counts(hops, equal=True)


def test_landed_children_and_singletons_are_loaded(spark, two_runs):
    lake = two_runs["lake"]
    expected = landing.landed_tables(spark, SF_SMALL, 1)
    comments = lake.read_some("raw", "raw_comments", [1])
    assert comments.count() == expected["comments"].count()
    assert {r.text for r in comments.select("text").distinct().collect()} == {r.text for r in expected["comments"].select("text").distinct().collect()}
    assert lake.read_some("raw", "raw_kudos", [1]).count() == expected["kudos"].count()
    assert lake.read_version("raw", "raw_athlete", 1).count() == expected["athlete"].count()
    assert lake.read_version("raw", "raw_stats_for_athlete", 1).count() == expected["stats"].count()


def test_landing_shapes_and_order(spark, tmp_path):
    import json

    from cairn.schemas import LANDED_KUDO, RAW_STATS

    rows = [{"activity_id": 1, "firstname": "A", "lastname": str(k), "resource_state": 2} for k in range(5)]
    (tmp_path / "array.json").write_text(json.dumps(rows, indent=2))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "one.json").write_text(json.dumps({"athlete_id": 7, "all_run_totals": {"count": 3}}, indent=2))
    for name, n in (("array.json", 5), ("lines.json", 5), ("empty.json", 0), ("missing.json", 0)):
        got = read_landed(spark, str(tmp_path / name), LANDED_KUDO, 9)
        assert [r.lastname for r in got.orderBy("row_seq").collect()] == [str(k) for k in range(n)], name
        assert got.where("batch_seq <> 9").isEmpty()
    one = read_landed(spark, str(tmp_path / "one.json"), RAW_STATS, 1).collect()
    assert [(r.athlete_id, r.all_run_totals["count"]) for r in one] == [(7, 3)]


def test_table_with_a_base_and_later_batches_is_whole(spark, two_runs, tmp_path):
    from cairn.plans import incremental

    lake = Lake(spark, str(tmp_path / "lake"))
    row = lambda k, seq: spark.createDataFrame([(k, seq, 0, f"v{seq}")], "id long, batch_seq long, row_seq long, v string")
    for b in (1, 2):
        lake.append_batch(row(b, b), "raw", "t", b)
    assert incremental.compact(lake, "raw", "t", ["id"]) == 2
    lake.append_batch(row(3, 3), "raw", "t", 3)
    assert lake.read_table("raw", "t").count() == 3
    lake.append_batch(row(5, 2), "raw", "t", 2)  # batch 2 again, after the compaction that held it
    ids = sorted(r.id for r in incremental.merge_on_read(lake, "raw", "t", ["id"]).collect())
    assert ids == [1, 3, 5]
    assert sorted(r.id for r in lake.read_table("raw", "t").collect()) == [1, 3, 5]


def test_create_table_if_absent_keeps_what_is_there(spark, tmp_path):
    from cairn.plans.publish import create_if_absent
    from cairn.schemas import RAW_ATHLETE

    lake = Lake(spark, str(tmp_path / "lake"))
    name = f"k2_{tmp_path.name.replace('-', '_')}"
    for n in (0, 1):
        create_if_absent(spark, lake, name, RAW_ATHLETE)
        assert spark.table(f"gold.{name}").count() == n
        if n == 0:
            spark.createDataFrame([(1, "a", "b", None, None)], RAW_ATHLETE).write.insertInto(f"gold.{name}")
    spark.sql(f"DROP TABLE gold.{name}")
