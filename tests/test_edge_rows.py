"""Edge rows through the layers: NULLs, zero distances, zone edges, ties,
empty landings, duplicate and NULL keys, colliding names."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from cairn.operators import bronze, dims, gold, ingest
from cairn.plans.medallion import Layers
from cairn.schemas import RAW_ACTIVITY, RAW_ACTIVITY_LANDED
from cairn.sources.files import read_json_records, read_or_empty
from conftest import raw_rows


def _act(i, **kw):
    base = {
        "id": i,
        "athlete": {"id": 7, "resource_state": 1},
        "name": f"a{i}",
        "sport_type": "Run",
        "type": "Run",
        "start_date": "2024-01-03T06:00:00Z",
        "start_date_local": "2024-01-03T07:00:00Z",
        "distance": 5000.0,
        "moving_time": 1500,
        "elapsed_time": 1600,
        "has_heartrate": True,
        "average_heartrate": 150.0,
        "max_heartrate": 170.0,
        "kudos_count": 1,
        "comment_count": 0,
        "pr_count": 0,
        "total_elevation_gain": 10.0,
    }
    base.update(kw)
    return base


def test_pace_null_for_zero_or_null_distance(spark):
    raw = raw_rows(spark, [_act(1), _act(2, distance=0.0), _act(3, distance=None), _act(4, distance=-1.0)])
    for single in (True, False):
        fact = Layers(raw, single_source=single).fact
        got = {r.activity_id: r.pace_min_per_km for r in fact.collect()}
        assert got[1] == 5.0 and got[2] is None and got[3] is None and got[4] is None


def test_single_source_fact_equals_join_form(spark):
    rows = [_act(i, distance=float(i * 1000), has_heartrate=i % 2 == 0, average_heartrate=100.0 + i) for i in range(1, 30)]
    raw = raw_rows(spark, rows)
    a = Layers(raw, single_source=True).fact
    b = Layers(raw, single_source=False).fact
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_heart_rate_masked_and_zone_edges(spark):
    hrs = [119.9, 120.0, 139.99, 140.0, 159.0, 160.0, 174.9, 175.0, None]
    raw = raw_rows(spark, [_act(i, average_heartrate=h) for i, h in enumerate(hrs, start=1)] + [
        _act(100, has_heartrate=False, average_heartrate=110.0)
    ])
    layers = Layers(raw)
    fact = {r.activity_id: r.hr_zone for r in layers.star("fact_activities").collect()}
    assert [fact[i] for i in range(1, 10)] == [
        "Zone 1 — Easy", "Zone 2 — Aerobic", "Zone 2 — Aerobic", "Zone 3 — Tempo", "Zone 3 — Tempo",
        "Zone 4 — Threshold", "Zone 4 — Threshold", "Zone 5 — Max", "Zone 5 — Max",
    ]
    # has_heartrate = false masks the value, and NULL falls into the top zone (kept for parity)
    assert fact[100] == "Zone 5 — Max"
    load = {r.activity_id for r in layers.gold("gold_training_load").collect()}
    assert 100 not in load and 9 not in load


def test_null_start_date_gives_null_dim_row(spark):
    raw = raw_rows(spark, [_act(1), _act(2, start_date=None)])
    dates = Layers(raw).star("dim_date").collect()
    assert any(r.date_id is None for r in dates) and len(dates) == 2


def test_iso_week_53_in_dim_date(spark):
    raw = raw_rows(spark, [_act(1, start_date="2021-01-03T10:00:00Z")])
    row = Layers(raw).star("dim_date").first()
    assert (row.week_number, row.day_name, str(row.week_start)) == (53, "Sunday", "2020-12-28")


def test_pb_efforts_nulls_last_and_tie_break(spark):
    rows = [_act(i, distance=None) for i in range(1, 6)]  # NULL paces must not fill the top
    rows += [_act(i, distance=5000.0, moving_time=1500) for i in range(20, 8, -1)]  # 12 equal paces
    top = gold.pb_efforts(Layers(raw_rows(spark, rows)).fact).collect()
    assert [r.activity_id for r in top] == list(range(9, 19))


def test_weekly_counts_sum_to_fact(spark):
    rows = [_act(i, start_date=f"2024-0{1 + i % 3}-1{i % 9}T06:00:00Z") for i in range(1, 40)]
    layers = Layers(raw_rows(spark, rows))
    weekly = layers.gold("gold_weekly_stats").agg(F.sum("activity_count")).first()[0]
    assert weekly == layers.fact.count() == 39
    assert "total_comments" in layers.gold("gold_weekly_stats").columns
    assert "total_comments" not in layers.gold("gold_monthly_stats").columns


def test_empty_json_array_reads_typed(spark, scratch):
    path = os.path.join(scratch, "empty.json")
    with open(path, "w") as fh:
        json.dump([], fh)
    df = read_json_records(spark, path, RAW_ACTIVITY, multiline=True)
    assert df.count() == 0 and df.schema == RAW_ACTIVITY
    assert bronze.activities(df).count() == 0


def test_single_object_json_reads_one_row(spark, scratch):
    path = os.path.join(scratch, "athlete.json")
    with open(path, "w") as fh:
        json.dump({"id": 7, "firstname": "A", "lastname": "B", "extra": 1}, fh, indent=2)
    from cairn.schemas import RAW_ATHLETE

    rows = read_json_records(spark, path, RAW_ATHLETE, multiline=True).collect()
    assert [(r.id, r.firstname, r.lastname) for r in rows] == [(7, "A", "B")]


def test_duplicate_key_in_batch_last_wins(spark):
    landed = raw_rows(
        spark,
        [
            {**_act(1, name="old"), "batch_seq": 1, "row_seq": 1},
            {**_act(1, name="new"), "batch_seq": 1, "row_seq": 2},
            {**_act(2, name="only"), "batch_seq": 1, "row_seq": 3},
            {**_act(1, name="older batch"), "batch_seq": 0, "row_seq": 9},
        ],
        landed=True,
    )
    merged = {r.id: r.name for r in ingest.keyed_merge(landed, ["id"]).collect()}
    assert merged == {1: "new", 2: "only"}


def test_null_key_in_history_does_not_block_new_rows(spark):
    history = raw_rows(spark, [_act(1), _act(None)])
    batch = raw_rows(spark, [_act(1), _act(2), _act(None)])
    new = ingest.new_keys_only(bronze.activities(batch), bronze.activities(history))
    assert [r.activity_id for r in new.collect()] == [2]


def test_empty_history_passes_everything_but_null_keys(spark):
    from cairn.schemas import BRONZE_ACTIVITIES

    empty = spark.createDataFrame([], BRONZE_ACTIVITIES)
    batch = raw_rows(spark, [_act(1), _act(2)])
    assert ingest.new_keys_only(bronze.activities(batch), empty).count() == 2


def test_read_or_empty_only_missing_path_is_first_run(spark, scratch):
    from cairn.schemas import BRONZE_ACTIVITIES

    df, first = read_or_empty(spark, os.path.join(scratch, "nope"), BRONZE_ACTIVITIES)
    assert first and df.count() == 0 and df.schema == BRONZE_ACTIVITIES
    bad = os.path.join(scratch, "corrupt")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as fh:
        fh.write("not parquet")
    df, first = read_or_empty(spark, bad, BRONZE_ACTIVITIES)
    assert not first
    try:
        df.count()
        raise AssertionError("a corrupt history must raise, not restart")
    except Exception as exc:  # noqa: BLE001
        assert "AssertionError" not in type(exc).__name__


def test_kudos_keys_are_columns_not_joined_text(spark):
    kudos = spark.createDataFrame(
        [(1, "A_B", "C", 2, 1, 1), (1, "A", "B_C", 2, 1, 2), (1, "A", "B_C", 2, 1, 3), (1, None, "X", 2, 1, 4), (1, None, "X", 2, 1, 5)],
        "activity_id bigint, firstname string, lastname string, resource_state bigint, batch_seq bigint, row_seq bigint",
    )
    merged = ingest.keyed_merge(kudos, ["activity_id", "firstname", "lastname"]).collect()
    assert sorted((r.firstname or "", r.lastname, r.row_seq) for r in merged) == [("", "X", 5), ("A", "B_C", 3), ("A_B", "C", 1)]


def test_child_worklist_missing_counts_are_zero(spark):
    raw = raw_rows(spark, [_act(1, comment_count=None, kudos_count=None), _act(2, comment_count=2, kudos_count=None), _act(3, kudos_count=0)])
    rows = {r.activity_id: (r.needs_comments, r.needs_kudos) for r in ingest.child_worklist(raw).collect()}
    assert rows == {2: (True, False)}


def test_incremental_filter_truncates_watermark_to_seconds(spark):
    wm = spark.createDataFrame([(dt.datetime(2024, 1, 3, 6, 0, 0, 900000),)], "high_watermark timestamp_ntz")
    raw = raw_rows(spark, [_act(1, start_date="2024-01-03T06:00:00Z"), _act(2, start_date="2024-01-03T06:00:01Z")])
    from cairn.functions import parse_ts_ntz

    got = ingest.incremental_filter(raw, wm, parse_ts_ntz(F.col("start_date")))
    assert [r.id for r in got.collect()] == [2]
    none = spark.createDataFrame([(None,)], "high_watermark timestamp_ntz")
    assert ingest.incremental_filter(raw, none, parse_ts_ntz(F.col("start_date"))).count() == 2
    # the same filter from an already-read value
    value = dt.datetime(2024, 1, 3, 6, 0, 0, 900000)
    assert [r.id for r in ingest.incremental_filter(raw, value, parse_ts_ntz(F.col("start_date"))).collect()] == [2]
    assert ingest.incremental_filter(raw, None, parse_ts_ntz(F.col("start_date"))).count() == 2


def test_dim_activity_type_per_athlete(spark):
    rows = [_act(1, sport_type="Run"), _act(2, sport_type="Run", athlete={"id": 8, "resource_state": 1}), _act(3, sport_type="Kitesurf"), _act(4, sport_type=None)]
    dim = Layers(raw_rows(spark, rows)).star("dim_activity_type").collect()
    assert sorted((r.athlete_id, r.activity_type_id, r.sport_category) for r in dim) == [
        (7, "Kitesurf", "Other"), (7, "Run", "Cardio"), (8, "Run", "Cardio"),
    ]


def test_layer_validation_raises_on_empty_target(spark):
    from cairn.operators import quality

    raw = raw_rows(spark, [_act(1)])
    counts = quality.layer_counts([("raw", raw, "empty", raw.where(F.lit(False)))])
    try:
        quality.validate_counts(counts)
        raise AssertionError("expected ValueError")
    except ValueError as exc:
        assert "0 rows" in str(exc)


def test_incremental_rollup_with_null_only_batch(spark, scratch):
    from cairn.plans import incremental
    from cairn.plans.lake import Lake

    lake = Lake(spark, scratch)
    parts = [Layers(raw_rows(spark, rows)).fact for rows in ([_act(1), _act(2, start_date=None)], [_act(3, start_date=None)])]
    for b, part in enumerate(parts, 1):
        incremental.append_states(lake, "gold_weekly_stats", part, b)
    got = incremental.merged_periods(lake, "gold_weekly_stats").collect()
    expected = gold.weekly_stats(parts[0].unionByName(parts[1])).collect()
    assert sorted((str(r.week_start), r.activity_count) for r in got) == sorted(
        (str(r.week_start), r.activity_count) for r in expected
    )
    assert sum(r.week_start is None for r in got) == 1


def test_record_without_a_time_is_not_lost_behind_a_watermark(spark):
    raw = raw_rows(spark, [_act(1, start_date=None), _act(2)])
    ts = F.col("start_date").cast("timestamp_ntz")
    kept = ingest.incremental_filter(raw, dt.datetime(2090, 1, 1), ts)
    assert [r.id for r in kept.collect()] == [1]


def test_athlete_with_several_records_is_one_row(spark):
    from cairn.operators import dims
    from cairn.schemas import RAW_ATHLETE

    athletes = spark.createDataFrame(
        [(1, "Ann", "B", None, None), (1, "Ann", "C", None, None), (2, None, None, None, None), (1, None, None, None, None)], RAW_ATHLETE
    )
    owners = spark.createDataFrame([(1,), (2,), (3,), (None,)], "athlete_id long")
    got = {r.athlete_id: r.athlete_name for r in dims.name_owners(owners, athletes).collect()}
    assert got == {1: "Ann C", 2: None, 3: None, None: None}
