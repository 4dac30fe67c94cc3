"""Order of landed records over files, splits and shapes; the two-phase merge."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import ingest
from cairn.schemas import LANDED_COMMENT, LANDED_ORDER
from cairn.sources import files, landing
from cairn.sources.files import landed_shapes, read_landed


def comment(i, text, author="A"):
    return {"id": i, "text": text, "created_at": None, "athlete": {"firstname": author, "lastname": None}, "activity_id": i // 10}


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_the_last_write_wins_over_files_and_splits(spark, tmp_path, small_splits):
    """Files of very different sizes, so Spark packs their splits out of order."""
    rng = random.Random(1)
    want = {}
    for k, n in enumerate([3, 400, 1, 90, 700, 2]):
        rows = [comment(rng.randint(0, 150), f"file {k} row {j} {'x' * rng.randint(0, 60)}") for j in range(n)]
        text = json.dumps(rows, indent=1) if k in (2, 3) else "\n".join(map(json.dumps, rows))
        (tmp_path / f"page-{k:02d}.json").write_text(text)
        want |= {r["id"]: r["text"] for r in rows}
    landed = read_landed(spark, str(tmp_path), LANDED_COMMENT, 4)
    assert landed.rdd.getNumPartitions() > 20  # splits within files
    assert landed.select("file_seq", "block_seq").distinct().count() > 20
    for order in (LANDED_ORDER,):
        merged = ingest.keyed_merge(landed, ["id"], order)
        assert {r.id: r.text for r in merged.collect()} == want and merged.count() == len(want)
    ordered = [r.text for r in landed.where("file_seq = 'page-04.json'").orderBy(*LANDED_ORDER).collect()]
    assert [t.split()[3] for t in ordered] == [str(j) for j in range(700)]


def test_files_are_judged_one_by_one(spark, tmp_path):
    one = [comment(k, "t") for k in range(3)]
    (tmp_path / "a-array.json").write_text("\n\n " + json.dumps(one, indent=2))
    (tmp_path / "b-lines.json").write_text("\n" + "\n".join(map(json.dumps, one)) + "\n\n")
    (tmp_path / "c-object.json").write_text(json.dumps(one[0], indent=2))
    (tmp_path / "d-blank.json").write_text(" \n\n")
    (tmp_path / "e-one-line.json").write_text(json.dumps([comment(k, "long " * 50) for k in range(2000)]))
    documents, lines = landed_shapes(spark, str(tmp_path))
    assert [[p.rsplit("/", 1)[1] for p in part] for part in (documents, lines)] == [["a-array.json", "c-object.json", "e-one-line.json"], ["b-lines.json"]]
    got = read_landed(spark, str(tmp_path), LANDED_COMMENT, 1).groupBy("file_seq").count().collect()
    assert {r.file_seq: r["count"] for r in got} == {"a-array.json": 3, "b-lines.json": 3, "c-object.json": 1, "e-one-line.json": 2000}
    assert read_landed(spark, f"{tmp_path}/d-blank.json", LANDED_COMMENT, 1).isEmpty()


def test_no_line_reaches_the_driver(spark, tmp_path, monkeypatch):
    """Of a landing saved as one long line only its name is collected."""
    from pyspark.sql.classic.dataframe import DataFrame

    (tmp_path / "one.json").write_text(json.dumps([comment(k, "y" * 100) for k in range(5000)]))
    sizes, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: sizes.append(len(str(rows := collect(self)))) or rows)
    monkeypatch.setattr(DataFrame, "head", None)
    assert files.landed_shapes(spark, str(tmp_path))[0] and max(sizes) < 1000


# ---------------------------------------------------------------- two-phase merge
RECORD = "id long, who string, batch_seq long, row_seq long, v string, nested struct<a:int,b:array<string>>"


def test_wide_merge_equals_a_plain_one(spark):
    rng = random.Random(2)
    rows = []
    for k in range(3000):
        key = (0, "hot") if k % 3 == 0 else (rng.choice([None, *range(40)]), rng.choice([None, "", "a", "b"]))
        rows.append((*key, rng.choice([None, 1, 2, 2**62]), rng.choice([None, -5, k % 700]), rng.choice([None, f"v{k}"]), rng.choice([None, (k, [None, "x"])])))
    records = spark.createDataFrame(rows, RECORD).repartition(8)
    low = lambda x: -(2**63) if x is None else x
    want = {}
    for r in rows:
        want.setdefault(r[:2], []).append(r)
    got = ingest.keyed_merge(records, ["id", "who"]).collect()
    assert records.columns == ingest.keyed_merge(records, ["id", "who"]).columns
    assert sorted((r.id, r.who) for r in got if None not in (r.id, r.who)) == sorted(k for k in want if None not in k) and len(got) == len(want)
    for r in got:
        held = want[r.id, r.who]
        best = max((low(x[2]), low(x[3])) for x in held)
        row = (r.id, r.who, r.batch_seq, r.row_seq, r.v, None if r.nested is None else (r.nested.a, r.nested.b))
        assert (low(r.batch_seq), low(r.row_seq)) == best and row in held


def test_wide_merge_sorts_no_full_records_and_spreads_hot_keys(spark):
    records = spark.range(3000).selectExpr("IF(id % 3 = 0, 0, id) AS id", "'w' AS who", "1L AS batch_seq", "id AS row_seq", "repeat('x', 50) AS v").repartition(8)
    merged = ingest.keyed_merge(records, ["id"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Union", 1)[1].split("max_by", 1)[0]
    assert "ShuffledHashJoin" in main and "SortMergeJoin" not in plan
    sorts = [line for line in main.splitlines() if "SortAggregate" in line]
    assert sorts and all("v#" not in line for line in sorts)  # narrow columns only
    assert merged.where("id = 0").first().row_seq == 2997 and merged.count() == 2001
    assert ingest.keyed_merge(records.limit(0), ["id"]).count() == 0


def test_repeated_records_are_one(spark):
    rows = [(1, "a", 1, 1, "same", None)] * 5 + [(1, "a", 1, 0, "older", None), (2, "a", 1, 1, "x", None), (2, "a", 1, 1, "y", None)]
    got = ingest.keyed_merge(spark.createDataFrame(rows, RECORD), ["id", "who"]).collect()
    assert sorted((r.id, r.v) for r in got)[0] == (1, "same") and len(got) == 2 and got != []
    assert {r.v for r in got if r.id == 2} <= {"x", "y"}


def test_order_columns_of_another_batch_win(spark, tmp_path):
    parts = []
    for b, text in ((1, "old"), (2, "new")):
        (tmp_path / f"{b}.json").write_text(json.dumps([comment(1, text), comment(1, f"{text} again")]))
        parts.append(read_landed(spark, f"{tmp_path}/{b}.json", LANDED_COMMENT, b))
    both = parts[1].unionByName(parts[0])
    assert [r.text for r in ingest.keyed_merge(both, ["id"], LANDED_ORDER).collect()] == ["new again"]
    assert both.where(F.col("file_seq").isNull()).isEmpty()


# ---------------------------------------------------------------- bounded arrays
def test_an_array_ends_after_so_many_records(spark, tmp_path):
    """One task's records make several files, each an array of its own, in order."""
    rows = spark.range(0, 23, 1, 1).selectExpr("id", "concat('text ', id) AS text")
    landing.write_arrays(rows, f"{tmp_path}/cut", per_file=5)
    arrays = [json.loads(p.read_text()) for p in sorted((tmp_path / "cut").glob("part-*"))]
    assert [len(a) for a in arrays] == [5, 5, 5, 5, 3]
    assert [r["id"] for a in arrays for r in a] == list(range(23)) and arrays[4][2] == {"id": 22, "text": "text 22"}
    landing.write_arrays(rows.where("id < 10"), f"{tmp_path}/even", per_file=5)
    assert [len(json.loads(p.read_text())) for p in sorted((tmp_path / "even").glob("part-*"))] == [5, 5]
    landing.write_arrays(rows.where("id < 0"), f"{tmp_path}/none", per_file=5)
    assert all(json.loads(p.read_text()) == [] for p in (tmp_path / "none").glob("part-*"))
    back = read_landed(spark, f"{tmp_path}/cut", rows.schema, 1).orderBy(*LANDED_ORDER)
    assert [r.id for r in back.collect()] == list(range(23))
    assert landing.ARRAY_RECORDS <= 50_000  # what the task that reads one array holds


def test_no_line_is_sorted_or_kept_to_tell_shapes(spark, tmp_path, monkeypatch):
    """Only positions are aggregated; a text is neither grouped, sorted nor shuffled."""
    from pyspark.sql.classic.dataframe import DataFrame

    (tmp_path / "a.json").write_text(json.dumps([comment(k, "t") for k in range(3)], indent=1))
    (tmp_path / "b.json").write_text("\n".join(json.dumps(comment(k, "t")) for k in range(3)))
    plans, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or collect(self))
    documents, lines = landed_shapes(spark, str(tmp_path))
    assert len(documents) == len(lines) == 1 and plans
    for plan in plans:
        kept = [line for line in plan.splitlines() if any(k in line for k in ("SortAggregate", "Exchange", "Sort [")) and ("line#" in line or "value#" in line)]
        assert not kept and "min_by" not in plan


def test_shapes_after_blank_blocks(spark, tmp_path, small_splits):
    """The first line that is not blank lies in a later block of the file."""
    record = json.dumps(comment(1, "x" * 100))
    blank = (" " * 99 + "\n") * 100
    (tmp_path / "a-lines.json").write_text(blank + "\n".join([record] * 50))
    (tmp_path / "b-object.json").write_text(blank + json.dumps(comment(1, "x" * 3000), indent=1) + "\n" + record)
    (tmp_path / "c-array.json").write_text(blank + json.dumps([comment(1, "x" * 100)] * 50, indent=1))
    (tmp_path / "d-lines.json").write_text("\n".join([record] * 50))
    documents, lines = landed_shapes(spark, str(tmp_path))
    assert [[p.rsplit("/", 1)[1] for p in part] for part in (documents, lines)] == [["b-object.json", "c-array.json"], ["a-lines.json", "d-lines.json"]]


def test_landed_lines_are_compressed_files_of_so_many_records(spark, tmp_path):
    rows = spark.range(0, 2300, 1, 1).selectExpr("id", "concat('an activity with much the same text ', id) AS text")
    landing.write_ndjson(rows, f"{tmp_path}/lines", per_file=500)
    written = sorted((tmp_path / "lines").glob("part-*"))
    parts = [[json.loads(t) for t in gzip.decompress(p.read_bytes()).splitlines()] for p in written]
    assert [len(p) for p in parts] == [500, 500, 500, 500, 300] and [r["id"] for p in parts for r in p] == list(range(2300))
    assert 5 * sum(p.stat().st_size for p in written) < sum(len(json.dumps(r)) for p in parts for r in p)
    back = files.read_json_records(spark, f"{tmp_path}/lines", rows.schema)
    assert back.exceptAll(rows).isEmpty() and back.count() == 2300
