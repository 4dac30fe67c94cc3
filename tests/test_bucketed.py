"""The join chain over bucketed bronze tables."""

import uuid

import pytest

from cairn.operators import bronze, silver
from cairn.plans.bucketed import FACT_SOURCES, BucketedLayer
from cairn.plans.medallion import Layers
from cairn.sources import fixtures
from conftest import SF_SMALL
from test_plans import _plan


@pytest.fixture()
def layer(spark, scratch):
    made = BucketedLayer(spark, f"b_{uuid.uuid4().hex[:8]}", f"{scratch}/bronze", buckets=4)
    yield made
    made.drop()


def write(layer, raw, batch):
    records = bronze.records(raw)
    for name in FACT_SOURCES:
        layer.write_batch(bronze.project(records, name), name, batch)


def test_the_chain_has_no_exchange(spark, layer):
    raw = fixtures.raw_activities(spark, SF_SMALL)
    for b in range(3):
        write(layer, raw.where(f"id % 3 = {b}"), b)
    write(layer, raw.where("id % 3 = 1"), 1)  # a retried batch replaces its own rows
    fact = layer.silver_fact()
    plan = _plan(fact)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 4 and "Bucketed: true" in plan
    want = Layers(raw, single_source=False).fact
    assert fact.columns == want.columns and fact.count() == want.count()
    assert fact.exceptAll(want).isEmpty()
    joined = silver.activities(layer.read("bronze_activities"), layer.read("bronze_metrics"))
    assert "Exchange" not in _plan(joined)
    counted = layer.read("bronze_activities").groupBy("activity_id").count()
    assert "Exchange" not in _plan(counted)  # the key check neither


def test_another_session_finds_the_batches(spark, layer):
    raw = fixtures.raw_activities(spark, SF_SMALL)
    write(layer, raw, 7)
    n = layer.silver_fact().count()
    layer.drop()  # as a catalog that is gone with its session
    again = BucketedLayer(spark, layer.schema, layer.root, buckets=4)
    write(again, raw.limit(0), 8)
    assert again.silver_fact().count() == n == raw.count()


def test_empty_and_null_keys(spark, layer):
    raw = fixtures.raw_activities(spark, SF_SMALL)
    write(layer, raw.limit(0), 1)
    assert layer.silver_fact().isEmpty()
    write(layer, raw.limit(5).withColumn("id", raw.id * None), 2)
    assert layer.read("bronze_activities").count() == 5 and layer.silver_fact().isEmpty()


def test_a_longer_history_has_more_buckets(spark, scratch, monkeypatch):
    """The query's tables hold so many rows a bucket, however many orders there are."""
    from cairn import queries
    from cairn.plans import bucketed

    assert bucketed.buckets_for(0) == bucketed.buckets_for(150_000) == 8
    assert [bucketed.buckets_for(n) for n in (9_000_000, 54_000_000)] == [36, 216]
    made = []
    monkeypatch.setattr(queries, "_scratch", lambda spark, name: f"{scratch}/{name}")
    monkeypatch.setattr(queries, "BucketedLayer", lambda *args, **kw: made.append(BucketedLayer(*args, **kw)) or made[0])
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 100)
    fact = queries.bucketed_activity_fact(spark, SF_SMALL)
    n = fixtures.raw_activities(spark, SF_SMALL).count()
    assert made[0].buckets == -(-n // 100) > 8
    assert "Exchange" not in _plan(fact) and fact.count() == n
    made[0].drop()
