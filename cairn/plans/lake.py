"""Parquet lake with version and batch directories.

Layout under the lake root, or under a layer's own location::

    <layer>/<table>/v=<n>/part-*.parquet      full-refresh tables
    <layer>/<table>/batch=<id>/part-*.parquet append-only tables
    <layer>/<table>/_commits/<folder>.json    what is readable: one small file each

* A write is aside until its commit file is there: rows, then an optional audit
  of what was written, then the commit file, by one rename. Readers list the
  commit files of a table in one request, however many folders there are, and
  see nothing of a write that failed or was refused.
* Full refresh never overwrites what it reads: it writes ``v=<n+1>`` and
  readers take the highest committed version.
* Appends write one directory per batch id with ``overwrite`` on that
  directory only, so a retried batch replaces its own partial output and
  nothing else.
* A commit file holds the rows of its folder, counted by an ``Observation`` as
  they were written (no second scan), and the least and greatest key of a table
  that is laid out by key. Such a table's files are sorted by the key and carry
  Bloom filters of it, and a reader with key ranges opens only the folders that
  can hold them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMIT = re.compile(r"^(v|batch)=(\d+)\.json$")


@dataclass(frozen=True)
class Location:
    """Where a layer lives, and the file-system options (credentials, endpoint)
    that hold for it alone: they go with each read and write of the layer and
    are never set on the session."""

    root: str
    options: Mapping[str, str] = field(default_factory=dict)


class Lake:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        options: Mapping[str, str] | None = None,
        layers: Mapping[str, Location] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.options = dict(options or {})
        self.layers = dict(layers or {})
        self._Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._systems: dict[tuple, object] = {}
        self._seen: dict[str, dict] = {}  # commit file -> its contents; dropped when the folder is written again

    # -- paths ------------------------------------------------------------
    def location(self, layer: str) -> Location:
        return self.layers.get(layer) or Location(f"{self.root}/{layer}", self.options)

    def table_path(self, layer: str, table: str) -> str:
        return f"{self.location(layer).root.rstrip('/')}/{table}"

    def _fs(self, layer: str):
        """The layer's file system. One with options of its own is a new
        instance, as the shared ones are kept by address and would ignore them."""
        at = self.location(layer)
        path = self._Path(at.root)
        if not at.options:
            return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        key = (at.root, tuple(sorted(at.options.items())))
        if key not in self._systems:
            jvm = self.spark.sparkContext._jvm
            conf = jvm.org.apache.hadoop.conf.Configuration(self.spark.sparkContext._jsc.hadoopConfiguration())
            for name, value in at.options.items():
                conf.set(name, value)
            self._systems[key] = jvm.org.apache.hadoop.fs.FileSystem.newInstance(path.toUri(), conf)
        return self._systems[key]

    # -- commits ------------------------------------------------------------
    def _commit_path(self, layer: str, table: str, kind: str, number: int) -> str:
        return f"{self.table_path(layer, table)}/_commits/{kind}={number}.json"

    def _committed(self, layer: str, table: str, kind: str) -> list[int]:
        """Committed folders, by one listing of a folder of small files."""
        fs, path = self._fs(layer), self._Path(f"{self.table_path(layer, table)}/_commits")
        if not fs.exists(path):
            return []
        names = (_COMMIT.match(status.getPath().getName()) for status in fs.listStatus(path))
        return sorted(int(m.group(2)) for m in names if m and m.group(1) == kind)

    def versions(self, layer: str, table: str) -> list[int]:
        return self._committed(layer, table, "v")

    def batches(self, layer: str, table: str) -> list[int]:
        return self._committed(layer, table, "batch")

    def exists(self, layer: str, table: str) -> bool:
        return bool(self.versions(layer, table) or self.batches(layer, table))

    def latest_path(self, layer: str, table: str) -> str:
        vs = self.versions(layer, table)
        if not vs:
            raise FileNotFoundError(f"{layer}/{table} has no committed version")
        return f"{self.table_path(layer, table)}/v={vs[-1]}"

    def commits(self, layer: str, table: str, kind: str, numbers: Iterable[int]) -> dict[int, dict]:
        """Contents of commit files: ``rows``, and ``low`` and ``high`` of the key.
        Files this object wrote or read before are not read again."""
        paths = {n: self._commit_path(layer, table, kind, n) for n in numbers}
        new = {n: p for n, p in paths.items() if p not in self._seen}
        if new:
            read = self._reader(layer).schema("number long, rows long, low long, high long").json(list(new.values()))
            for r in read.collect():  # one row a folder
                self._seen[new[r["number"]]] = {"rows": r["rows"], "low": r["low"], "high": r["high"]}
        return {n: self._seen[p] for n, p in paths.items()}

    def overlapping(self, layer: str, table: str, ids: list[int], ranges: list[tuple[int, int]]) -> list[int]:
        """The batches, of a table laid out by key, that can hold a key of ``ranges``."""
        held = self.commits(layer, table, "batch", ids)
        return [b for b, c in held.items() if c["low"] is not None and any(lo <= c["high"] and c["low"] <= hi for lo, hi in ranges)]

    def rows(self, layer: str, table: str) -> int:
        """Rows of a table as its writes counted them: the latest version and all
        batches after it. Reads commit files, no data."""
        versions, later = self._current(layer, table)
        found = self.commits(layer, table, "v", versions).values(), self.commits(layer, table, "batch", later).values()
        return sum(c["rows"] for part in found for c in part)

    # -- writes -------------------------------------------------------------
    def _write(self, df: DataFrame, layer: str, table: str, kind: str, number: int, key: str | None, audit) -> tuple[str, int]:
        fs, path = self._fs(layer), f"{self.table_path(layer, table)}/{kind}={number}"
        commit = self._commit_path(layer, table, kind, number)
        fs.delete(self._Path(commit), False)
        self._seen.pop(commit, None)
        obs, counted = Observation(), [F.count(F.lit(1)).alias("rows")]
        writer_options = {"compression": "zstd", **self.location(layer).options}
        if key:
            df = df.sortWithinPartitions(key)
            counted += [F.min(key).alias("low"), F.max(key).alias("high")]
            writer_options[f"parquet.bloom.filter.enabled#{key}"] = "true"
        df.observe(obs, *counted).write.mode("overwrite").options(**writer_options).parquet(path)
        if audit:
            audit(self._reader(layer).schema(df.schema).parquet(path))
        held = {"rows": int(obs.get["rows"]), "low": obs.get.get("low"), "high": obs.get.get("high")}
        aside = self._Path(f"{commit}.{id(df)}.tmp")
        out = fs.create(aside, True)
        out.write(bytearray(json.dumps({"number": number, **held}).encode()))
        out.close()
        if not fs.rename(aside, self._Path(commit)):
            raise OSError(f"{commit} could not be written")
        self._seen[commit] = held
        return path, held["rows"]

    def write_version(self, df: DataFrame, layer: str, table: str, version: int | None = None) -> tuple[str, int]:
        """Full refresh (``CREATE OR REPLACE ... AS``, ``COPY ... TO``) as the
        next version, or as a given version number (idempotent on retry)."""
        if version is None:
            vs = self.versions(layer, table)
            version = (vs[-1] + 1) if vs else 1
        return self._write(df, layer, table, "v", version, None, None)

    def append_batch(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        batch_id: int,
        key: str | None = None,
        audit: Callable[[DataFrame], None] | None = None,
    ) -> tuple[str, int]:
        """Append-only insert of one batch; rerunning the batch replaces it.

        ``key`` (a long) lays the batch out by that column. ``audit`` gets the rows
        as written and raises to refuse them: they are then never readable."""
        done = self._write(df, layer, table, "batch", batch_id, key, audit)
        for version in self.versions(layer, table):
            if version >= batch_id:  # a compacted base that holds the batch's old rows
                self._fs(layer).delete(self._Path(self._commit_path(layer, table, "v", version)), False)
                self._fs(layer).delete(self._Path(f"{self.table_path(layer, table)}/v={version}"), True)
        return done

    # -- reads ----------------------------------------------------------------
    def _reader(self, layer: str):
        return self.spark.read.options(**self.location(layer).options)

    def read(self, layer: str, table: str) -> DataFrame:
        return self._reader(layer).parquet(self.latest_path(layer, table))

    def _current(self, layer: str, table: str) -> tuple[list[int], list[int]]:
        versions = self.versions(layer, table)[-1:]
        return versions, [b for b in self.batches(layer, table) if not versions or b > versions[-1]]

    def read_table(self, layer: str, table: str) -> DataFrame:
        """Whole table: the latest version and all committed batches after it."""
        versions, later = self._current(layer, table)
        parts = [self.read_version(layer, table, versions[-1])] if versions else []
        parts += [self.read_some(layer, table, later)] if later else []
        if not parts:
            raise FileNotFoundError(f"{layer}/{table} has no committed data")
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def batch_paths(self, layer: str, table: str, ids: list[int] | None = None) -> list[str]:
        ids = self.batches(layer, table) if ids is None else ids
        return [f"{self.table_path(layer, table)}/batch={b}" for b in ids]

    def read_some(self, layer: str, table: str, ids: list[int]) -> DataFrame:
        """Given batches of an append-only table (the batch id is layout, not data)."""
        return self._reader(layer).option("basePath", self.table_path(layer, table)).parquet(*self.batch_paths(layer, table, ids)).drop("batch")

    # -- finished runs ------------------------------------------------------
    def finish(self, run_id: int, batch_ids: list[int]) -> None:
        """Record, as a run's last and only atomic step, the batches that are now
        in every table."""
        rows = self.spark.createDataFrame([(b,) for b in batch_ids], "batch_id long")
        self.append_batch(rows.coalesce(1), "meta", "finished", run_id)

    def finished(self) -> tuple[list[int], set[int]]:
        """(finished runs, batches they finished): one row a batch."""
        runs = self.batches("meta", "finished")
        done = {r[0] for r in self.read_some("meta", "finished", runs).collect()} if runs else set()
        return runs, done

    def read_version(self, layer: str, table: str, version: int) -> DataFrame:
        return self._reader(layer).parquet(f"{self.table_path(layer, table)}/v={version}")

    def read_batches(
        self, layer: str, table: str, schema: T.StructType, exclude: int | None = None, ranges: list[tuple[int, int]] | None = None
    ) -> DataFrame:
        """All committed batches of an append-only table (empty if none).

        ``exclude`` leaves out one batch id, so a retried batch is compared
        with the history before it, not with its own partial output. With
        ``ranges`` of a table laid out by key, only the batches whose keys
        overlap one of them are read, the others not even opened.
        """
        ids = [b for b in self.batches(layer, table) if b != exclude]
        if ranges is not None:
            ids = self.overlapping(layer, table, ids, ranges)
        if not ids:
            return self.spark.createDataFrame([], schema)
        base = self.table_path(layer, table)
        paths = [f"{base}/batch={b}" for b in ids]
        # the batch id is layout, not data: drop the discovered partition column
        return self._reader(layer).schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)
