"""WARC archives: exact round trips, revisits, push-down and skipping."""

import base64
import gzip
import hashlib
import os
import uuid
from collections import defaultdict

import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from cairn.llm import warc
from cairn.session import shared_dir


def place(spark):
    return f"{shared_dir(spark)}/warc-test-{uuid.uuid4().hex}"


ROWS = [
    (1, "http://a.example/x", "<p>one</p>"),
    (2, None, None),
    (3, "http://a\r\nb/", "dup"),
    (9, "u", "dup"),
    (9, "u", "dup"),
    (5, "x", ""),
    (None, "n", "dup"),
    (11, "r", "many"),
    *[(11, "r", "many")] * 7,
    (11, None, "many"),
    (10, "r", "many"),
    (7, "long", "é<x>\r\n\r\nWARC/1.1" * 60_000),
    (8, "https://b.example/", "\r\n\r\n"),
]


def expected(rows):
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[(html or "").encode()].append(page)
    for payload, pages in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        pages = sorted(pages, key=lambda p: -1 if p is None else p)
        yield pages[-1], len(payload), digest, "response", None
        for page in pages[:-1]:
            yield page, len(payload), digest, "revisit", pages[-1]


@pytest.mark.parametrize("most", [warc.BROADCAST_BYTES, -1])
def test_round_trip_with_revisits(spark, monkeypatch, most):
    monkeypatch.setattr(warc, "BROADCAST_BYTES", most)  # below: digests meet by shuffle
    monkeypatch.setattr(warc, "CHUNK", 3)
    path = place(spark)
    pages = spark.createDataFrame([(*r, "extra") for r in ROWS], "page_id long, url string, html string, payload string").repartition(4)
    warc.archive_pages(pages, path)
    got = [tuple(r) for r in warc.archived_pages(spark, path).collect()]
    assert sorted(got, key=str) == sorted(expected(ROWS), key=str)


def test_small_payloads_are_all_responses(spark):
    path = place(spark)
    warc.archive_pages(spark.createDataFrame([r for r in ROWS if r[0]], "page_id long, url string, html string"), path, min_bytes=4)
    kinds = {(r.page_id, r.record_type) for r in warc.archived_pages(spark, path).collect()}
    assert {(3, "response"), (9, "response")} <= kinds and (3, "revisit") not in kinds


def test_predicates_reach_the_reader(spark):
    path = place(spark)
    warc.archive_pages(spark.createDataFrame(ROWS, "page_id long, url string, html string"), path)
    df = warc.read_archive(spark, path, payload=False).where((F.col("record_type") == "response") & F.col("target_uri").startswith("https"))
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "EqualTo(record_type,response)" in plan and "StringStartsWith(target_uri,https)" in plan
    rows = df.collect()
    assert [(r.target_uri, r.payload) for r in rows] == [("https://b.example/", None)]
    assert warc.read_archive(spark, path).where("payload_bytes > 100000").count() == 1  # not pushed, still right


def test_rejected_payloads_are_not_inflated(tmp_path, monkeypatch):
    block = lambda k: warc.record_block({"record_type": "response", "record_id": f"<r:{k}>", "payload": os.urandom(300_000)})
    (tmp_path / "a.warc.gz").write_bytes(b"".join(warc.gzip_member(block(k)) for k in range(5)))
    fs, path = warc.filesystem(str(tmp_path / "a.warc.gz"))
    inflated = []
    monkeypatch.setattr(warc._Inflated, "body", lambda self, n: inflated.append(n) or b"")
    with fs.open_input_file(path) as f:
        got = list(warc.records(f, os.path.getsize(path), lambda h: h["WARC-Record-ID"] == "<r:3>", True))
    assert len(got) == 1 and len(inflated) == 1


def test_archives_of_other_writers(spark, tmp_path):
    block = lambda k: warc.record_block({"record_type": "response", "record_id": f"<urn:page:{k}>", "payload": b"p%d" % k * 20_000})
    (tmp_path / "plain.warc").write_bytes(b"".join(block(k) for k in range(4)))
    (tmp_path / "other.warc.gz").write_bytes(b"".join(gzip.compress(block(k)) for k in range(4, 8)))
    for payload in (True, False):
        rows = warc.read_archive(spark, str(tmp_path), payload).where("record_type = 'response'").collect()
        assert sorted(r.record_id for r in rows) == [f"<urn:page:{k}>" for k in range(8)]
        assert all((r.payload == b"p%d" % int(r.record_id[10:-1]) * 20_000) if payload else r.payload is None for r in rows)


def test_files_roll_and_group(spark):
    path = place(spark)
    warc.register(spark)
    rows = spark.range(60).selectExpr("id AS page_id", "'u' AS url", "repeat(sha2(cast(id AS string), 256), 200) AS html").coalesce(2)
    warc.archive_pages(rows, path)
    reader = warc.WarcReader({"path": path, "partition_bytes": "1"})
    assert len(reader.partitions()) == len([f for p in reader.partitions() for f in p.files])
    assert len(warc.WarcReader({"path": path}).partitions()) == 1
    assert warc.archived_pages(spark, path).count() == 60


def one_page(spark, k):
    return spark.createDataFrame([(k, "u", f"h{k}")], "page_id long, url string, html string")


def ids(spark, path):
    return sorted(r.page_id for r in warc.archived_pages(spark, path).collect())


def test_payloads_are_not_shuffled(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    plan = warc.with_revisits(pages.where("page_id != 11 AND page_id != 9"))
    text = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_unfinished_files_are_not_read(spark):
    path = place(spark)
    fs, root = warc.filesystem(path)
    writer = warc.WarcWriter({"path": path}, False)
    message = writer.write(warc.WarcReader.batch([]) for _ in ())
    with_row = warc.WarcWriter({"path": path}, False)
    rows = [{"record_type": "response", "record_id": "<urn:page:7>", "payload": b"p"}]
    done = with_row.write(iter([pa.RecordBatch.from_pylist(rows)]))
    # a first write that has not committed reads as nothing, not in part
    assert done.files and ids(spark, path) == []
    warc.archive_pages(one_page(spark, 1), path)
    with fs.open_output_stream(f"{root}/{warc.PARTS}/part-lost.warc.gz", compression=None) as f:
        f.write(b"\x1f\x8b half a file of a lost task")
    with fs.open_output_stream(f"{root}/{warc.LISTS}/lost.writing", compression=None) as f:
        f.write(b"{half a list")
    assert ids(spark, path) == [1]
    # both writers commit, in any order: no list is written over
    with_row.commit([done, None])
    writer.commit([message])
    assert ids(spark, path) == [1, 7]


def test_overwrite_replaces_and_removes(spark):
    path = place(spark)
    fs, root = warc.filesystem(path)
    for k in (1, 2):
        warc.archive_pages(one_page(spark, k), path)
    with fs.open_output_stream(f"{root}/foreign.warc.gz", compression=None) as f:
        f.write(warc.gzip_member(warc.record_block({"record_type": "response", "record_id": "<urn:page:3>", "payload": b"p"})))
    assert ids(spark, path) == [1, 2, 3]
    warc.archive_pages(one_page(spark, 4), path, mode="overwrite")
    assert ids(spark, path) == [4]
    archives = [i.path for i in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if i.path.endswith((".gz", ".json"))]
    assert len(archives) == 2  # one archive, its list
    warc.archive_pages(one_page(spark, 5), path)
    assert ids(spark, path) == [4, 5]


def test_overwrite_that_crashed_before_its_deletes(spark, monkeypatch):
    path = place(spark)
    fs, root = warc.filesystem(path)
    warc.archive_pages(one_page(spark, 1), path)
    old = {i.path: fs.open_input_stream(i.path, compression=None).read() for i in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if i.path.endswith((".gz", ".json"))}
    warc.archive_pages(one_page(spark, 2), path, mode="overwrite")
    for name, data in old.items():
        with fs.open_output_stream(name, compression=None) as f:
            f.write(data)
    assert ids(spark, path) == [2]
    warc.archive_pages(one_page(spark, 3), path, mode="overwrite")
    assert ids(spark, path) == [3]
    assert not any(fs.get_file_info(name).type == pafs.FileType.File for name in old)


def test_empty_table(spark):
    path = place(spark)
    warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.archived_pages(spark, path).count() == 0
