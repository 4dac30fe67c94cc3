"""Incremental line dedup that can be undone: cuckoo filters over exact counts.

A line's key is the line without surrounding ASCII white space, A-Z lower-cased;
keys of fewer than ``MIN_CHARS`` characters are left alone. Of the documents that
hold a key, only the one with the smallest id keeps its lines.

:class:`LineIndex` is a folder of tables, one part a batch, kept by hash of key:

* ``refs``: one row for each document of the batch and key in it;
* ``counts``: the exact reference counts: for each key that a batch changed, the
  documents that hold it since and the smallest of their ids (``owner``);
* ``filters``: a cuckoo filter for each shard of the keys' hash space, which holds
  exactly the keys with a count above 0;
* ``gone``: the ids a batch deleted; ``commits``: the batches that are whole.

:meth:`LineIndex.insert` sends the batch's keys to the shards' filters. A key the
filter doesn't hold is new for certain; only the others are looked up in the
exact counts. :meth:`LineIndex.delete` lowers counts, finds the next owner from the
references left, and takes keys that no document holds any more out of the
filters. So any order of inserts and deletions that leaves the same documents
leaves the same counts, and documents that lost lines to a deleted one get them
back. :meth:`LineIndex.kept` gives the documents without the lines they lose.

Shards double with the number of keys (their filters are then made anew from the
exact counts), so a filter and the keys sent to it stay bounded. A line held by
many documents is one row a task when counted; when lines are looked up, the keys
with more than one ten-thousandth of all references, at most 10,000, are joined
in place, so no key brings more than that share of the rows to one task.

A batch counts only when its commit is written, as the last step; one that was
lost midway is overwritten by the next. One writer at a time.

Defined results: null or empty text is one empty line. Rows that share an id are
one document as to owners, and each keeps its own text; so are all rows with a
null id, which counts as the largest. Repeated rows are returned as often as they
occur. An empty table gives no rows. Other columns of the input don't matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.plans.lake import Lake

from .common import arrow_map, forget, mix, written

MIN_CHARS = 10
#: Keys a shard holds on average at most, and shards at least.
SHARD_KEYS, SHARDS = 200_000, 16
#: Buckets of a filter (4 slots each) and the moves an insertion may take.
BUCKETS, SLOTS, MOVES = 1 << 16, 4, 500
#: Keys with more than one in so many references are joined in place.
HOT = 10_000
NO_ID = 2**63 - 1
KEY = ["hi", "lo"]


# --------------------------------------------------------------- cuckoo filter
class CuckooFilter:
    """Fingerprints of 16 bits in buckets of 4, each in one of two buckets.

    Holds a fingerprint once for each key added. Keys are 64-bit hashes, in
    arrays. What finds no place within ``MOVES`` goes to ``rest``, so nothing is
    ever lost; only keys that were added may be removed."""

    def __init__(self, slots: np.ndarray | None = None, rest: np.ndarray | None = None, buckets: int | None = None):
        self.slots = np.zeros((buckets or BUCKETS, SLOTS), np.uint16) if slots is None else slots
        self.rest = np.empty(0, np.int64) if rest is None else rest
        self.mask = len(self.slots) - 1

    @classmethod
    def loaded(cls, slots: bytes, rest: bytes) -> CuckooFilter:
        return cls(np.frombuffer(slots, np.uint16).reshape(-1, SLOTS).copy(), np.frombuffer(rest, np.int64).copy())

    def stored(self) -> tuple[bytes, bytes]:
        return self.slots.tobytes(), self.rest.tobytes()

    def __len__(self) -> int:
        return int(np.count_nonzero(self.slots)) + len(self.rest)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys.astype(np.uint64))
        mark = ((h & np.uint64(0xFFFF)) % np.uint64(0xFFFF) + np.uint64(1)).astype(np.uint16)
        return mark, ((h >> np.uint64(16)).astype(np.int64)) & self.mask

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(mark.astype(np.uint64)).astype(np.int64) & self.mask)

    def _packed(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return np.minimum(bucket, self._other(bucket, mark)) << 16 | mark.astype(np.int64)

    @staticmethod
    def _turn(values: np.ndarray) -> np.ndarray:
        """Each element's number among its equals, from 0."""
        order = np.argsort(values, kind="stable")
        new = np.r_[True, values[order][1:] != values[order][:-1]] if len(values) else np.empty(0, bool)
        start = np.maximum.accumulate(np.where(new, np.arange(len(values)), 0)) if len(values) else np.empty(0, np.int64)
        out = np.empty(len(values), np.int64)
        out[order] = np.arange(len(values)) - start
        return out

    def _place(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Puts marks into free slots of their bucket; which were put."""
        full = self.slots[bucket] != 0
        turn = self._turn(bucket)
        fits = turn < SLOTS - full.sum(axis=1)
        slot = np.argsort(full, axis=1, kind="stable")[fits, turn[fits]]  # free slots first
        self.slots[bucket[fits], slot] = mark[fits]
        return fits

    def add(self, keys: np.ndarray) -> None:
        mark, bucket = self._places(keys)
        for _ in range(2):
            left = ~self._place(bucket, mark)
            mark, bucket = mark[left], self._other(bucket[left], mark[left])
        for move in range(MOVES):
            if not len(mark):
                return
            # one mark a bucket moves another one out, which tries its other bucket
            first = self._turn(bucket) == 0
            b, slot = bucket[first], (mark[first].astype(np.int64) + move) % SLOTS
            out = self.slots[b, slot].copy()
            self.slots[b, slot] = mark[first]
            bucket = np.r_[self._other(b, out), bucket[~first]]
            mark = np.r_[out, mark[~first]]
            left = ~self._place(bucket, mark)
            mark, bucket = mark[left], bucket[left]
        self.rest = np.sort(np.r_[self.rest, self._packed(bucket, mark)])

    def has(self, keys: np.ndarray) -> np.ndarray:
        mark, bucket = self._places(keys)
        found = (self.slots[bucket] == mark[:, None]).any(axis=1) | (self.slots[self._other(bucket, mark)] == mark[:, None]).any(axis=1)
        return found | np.isin(self._packed(bucket, mark), self.rest)

    def remove(self, keys: np.ndarray) -> None:
        mark, bucket = self._places(keys)
        while len(mark):
            now = self._turn(self._packed(bucket, mark)) == 0  # equal marks one after another
            gone = np.zeros(len(mark), bool)
            for side in (bucket, self._other(bucket, mark)):
                hit = self.slots[side] == mark[:, None]
                at = np.flatnonzero(now & ~gone & hit.any(axis=1))
                self.slots[side[at], hit[at].argmax(axis=1)] = 0
                gone[at] = True
            for x in self._packed(bucket, mark)[now & ~gone]:
                k = np.searchsorted(self.rest, x)
                if k == len(self.rest) or self.rest[k] != x:
                    raise KeyError("a key that was never added")
                self.rest = np.delete(self.rest, k)
            mark, bucket = mark[~now], bucket[~now]


# --------------------------------------------------------------- keys of lines
def key_of(line: bytes) -> bytes | None:
    """16 bytes of SHA-256 of the line's key; None for a short one."""
    key = line.strip().lower()  # of bytes: \\x20 and \\x09-\\x0D, A-Z
    if len(key) < MIN_CHARS or (len(key) < 4 * MIN_CHARS and len(key.decode("utf-8", "replace")) < MIN_CHARS):
        return None
    return hashlib.sha256(key).digest()[:16]


def named(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc (null id: the largest number), same (16 bytes of the text's SHA-256), text."""
    filled = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.col(key).isNull().alias("no_id"),
        F.unhex(F.substring(F.sha2(filled, 256), 1, 32)).alias("same"),
        filled.alias("text"),
    )


def references(rows: DataFrame) -> DataFrame:
    """doc, same, hi, lo: each row's different keys."""

    def cut(batch: pa.RecordBatch) -> dict:
        at, keys = [], []
        for k, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
            found = {d for d in map(key_of, text.split(b"\n")) if d is not None}
            at += [k] * len(found)
            keys += found
        pairs = np.frombuffer(b"".join(keys), ">i8").astype(np.int64).reshape(-1, 2)
        where = pa.array(at, pa.int64())
        return {"doc": batch.column(0).take(where), "same": batch.column(1).take(where), "hi": pairs[:, 0], "lo": pairs[:, 1]}

    return arrow_map(rows.select("doc", "same", "text"), cut, "doc long, same binary, hi long, lo long")


def without_lines(text: bytes, lost: set[bytes]) -> tuple[bytes, int, int]:
    """(text without the lines whose key is lost, lines, lines dropped)."""
    lines = text.split(b"\n")
    left = [x for x in lines if key_of(x) not in lost] if lost else lines
    return b"\n".join(left), len(lines), len(lines) - len(left)


# ----------------------------------------------------------------------- index
class LineIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.lake = spark, Lake(spark, path)

    # -- state
    def _commits(self) -> dict[int, tuple[int, int, bool]]:
        """Whole batches -> (shards, keys ever added at most, is a deletion)."""
        done = self.lake.batches("index", "commits")
        rows = self.lake.read_some("index", "commits", done).collect() if done else []
        return {r["number"]: (r["shards"], r["keys"], r["deletion"]) for r in rows}

    def _table(self, name: str, schema: str) -> DataFrame:
        """All whole batches of a table, with their ``batch``. (A folder left by a
        lost batch may bear the number of a later one of the other kind.)"""
        deletion = {"refs": (False,), "gone": (True,)}.get(name, (False, True))
        done = self._commits()
        ids = [b for b in self.lake.batches("index", name) if b in done and done[b][2] in deletion]
        if not ids:
            return self.spark.createDataFrame([], f"{schema}, batch int")
        root = self.lake.table_path("index", name)
        return self.spark.read.schema(f"{schema}, batch int").option("basePath", root).parquet(*self.lake.batch_paths("index", name, ids))

    def counts(self) -> DataFrame:
        """hi, lo, docs, owner of every key that documents hold."""
        changes = self._table("counts", "hi long, lo long, docs long, owner long")
        last = changes.groupBy(*KEY).agg(F.max(F.struct("batch", "docs", "owner")).alias("c"))
        return last.select(*KEY, "c.docs", "c.owner").where("docs > 0")

    def references(self) -> DataFrame:
        """doc, same, hi, lo of the documents that are in the index."""
        refs = self._table("refs", "doc long, same binary, hi long, lo long")
        gone = self._table("gone", "doc long").groupBy("doc").agg(F.max("batch").alias("until"))
        live = refs.join(gone, "doc", "left").where(F.col("until").isNull() | (F.col("batch") > F.col("until")))
        return live.select("doc", "same", *KEY)

    def filters(self, shards: int) -> DataFrame:
        """shard, slots, rest of each shard: as stored by the last batch, or made
        from the counts where there are more shards now."""
        done = self._commits()
        if done and done[max(done)][0] == shards:
            return self.lake.read_some("index", "filters", [max(done)])
        made = lambda shard, table: _filled(shard[0].as_py(), CuckooFilter(), add=table)
        keys = self.counts().select(_shard(shards), *KEY)
        return keys.groupBy("shard").applyInArrow(made, FILTER)

    # -- changes
    def insert(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> int:
        """Adds documents as one batch; its number."""
        done = self._commits()
        batch = max(done, default=0) + 1
        rows = references(named(docs, key, text))
        _, n = self.lake.append_batch(rows, "index", "refs", batch)
        new = self.lake.read_some("index", "refs", [batch]).groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("owner"))
        old_shards, old_keys, _ = done[max(done)] if done else (SHARDS, 0, False)
        shards = old_shards
        while shards * SHARD_KEYS < old_keys + n:
            shards *= 2
        filters = written(self.filters(shards), "line-filters")
        seen = new.select(_shard(shards), "*").groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(_probe, "hi long, lo long, docs long, owner long, seen boolean")
        seen = written(seen, "line-seen")
        old = self.counts().select(*KEY, F.col("docs").alias("old_docs"), F.col("owner").alias("old_owner"))
        known = seen.where("seen").join(old, KEY, "left")
        first = seen.where("NOT seen").withColumns({c: F.lit(None).cast("long") for c in ("old_docs", "old_owner")})
        after = known.unionByName(first).select(
            *KEY, (F.col("docs") + F.coalesce("old_docs", F.lit(0))).alias("docs"), F.least("owner", "old_owner").alias("owner"), F.col("old_docs").isNull().alias("fresh")
        )
        after = written(after, "line-counts")
        _, n = self.lake.append_batch(after.drop("fresh"), "index", "counts", batch)
        self._store_filters(filters, after.where("fresh"), after.limit(0), shards, batch)
        self._commit(batch, shards, old_keys + n, deletion=False)
        forget(self.spark, filters, seen, after)
        return batch

    def delete(self, ids: DataFrame, key: str = "doc_id") -> int:
        """Takes the documents with these ids out, as one batch; its number. Ids
        that are not in the index change nothing."""
        done = self._commits()
        batch = max(done, default=0) + 1
        shards, keys, _ = done[max(done)] if done else (SHARDS, 0, True)
        out = ids.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc")).distinct()
        self.lake.append_batch(out, "index", "gone", batch)
        out = self.lake.read_some("index", "gone", [batch])
        live = self.references()
        changed = written(live.join(out, "doc", "left_semi").select(*KEY).distinct(), "line-changed")
        left = live.join(out, "doc", "left_anti").join(changed, KEY, "left_semi").groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("owner"))
        after = written(changed.join(left, KEY, "left").select(*KEY, F.coalesce("docs", F.lit(0)).alias("docs"), "owner"), "line-counts")
        self.lake.append_batch(after, "index", "counts", batch)
        filters = written(self.filters(shards), "line-filters")
        self._store_filters(filters, after.limit(0), after.where("docs = 0"), shards, batch)
        self._commit(batch, shards, keys, deletion=True)
        forget(self.spark, changed, after, filters)
        return batch

    def _store_filters(self, filters: DataFrame, fresh: DataFrame, dead: DataFrame, shards: int, batch: int) -> None:
        changes = fresh.select(_shard(shards), *KEY, F.lit(True).alias("add")).unionByName(dead.select(_shard(shards), *KEY, F.lit(False).alias("add")))
        stored = changes.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(_changed, FILTER)
        self.lake.append_batch(stored, "index", "filters", batch)

    def _commit(self, batch: int, shards: int, keys: int, deletion: bool) -> None:
        row = self.spark.createDataFrame([(batch, shards, keys, deletion)], "number int, shards int, keys long, deletion boolean")
        self.lake.append_batch(row.coalesce(1), "index", "commits", batch)

    # -- results
    def lost(self) -> DataFrame:
        """doc, same, hi, lo: the keys whose lines a document of the index loses."""
        shared = written(self.counts().where("docs > 1"), "line-shared")
        refs = self.references()
        total = refs.count()
        hot = shared.where(F.col("docs") * HOT > total).select(*KEY, F.col("owner").alias("hot_owner"))  # fewer than HOT keys
        met = refs.join(F.broadcast(hot), KEY, "left")
        there = met.where("hot_owner < doc").drop("hot_owner")
        rest = met.where("hot_owner IS NULL").drop("hot_owner")
        cold = shared.where(F.col("docs") * HOT <= total).select(*KEY, "owner")
        return there.unionByName(rest.join(cold, KEY).where("owner < doc").drop("owner"))

    def kept(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """doc_id, kept, n_lines, n_dropped for each of ``docs``, which should be
        in the index (others lose nothing)."""
        which = ["doc", "same"]
        lost = self.lost().groupBy(*which).agg(F.collect_set(F.struct(*KEY)).alias("lost"))  # of one text: at most its lines
        rows = named(docs, key, text).groupBy(*which).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"), F.count_if("no_id").alias("no_ids"))

        def drop(batch: pa.RecordBatch) -> dict:
            col = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
            done = []
            for body, keys in zip(col["text"].cast(pa.binary()).to_pylist(), col["lost"].to_pylist()):
                gone = {int(k["hi"]).to_bytes(8, "big", signed=True) + int(k["lo"]).to_bytes(8, "big", signed=True) for k in keys or ()}
                done.append(without_lines(body, gone))
            texts = pa.array([x[0] for x in done], pa.binary()).cast(pa.string())
            return {"doc": col["doc"], "copies": col["copies"], "no_ids": col["no_ids"], "kept": texts, "n_lines": [x[1] for x in done], "n_dropped": [x[2] for x in done]}

        whole = arrow_map(rows.join(lost, which, "left").select("doc", "copies", "no_ids", "text", "lost"), drop, "doc long, copies long, no_ids long, kept string, n_lines long, n_dropped long")
        each = whole.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        return each.select(F.when(F.col("copy") > F.col("no_ids"), F.col("doc")).alias("doc_id"), "kept", "n_lines", "n_dropped")


FILTER = "shard int, slots binary, rest binary"


def _shard(shards: int):
    """The shard of a key: its leading bits."""
    return F.shiftrightunsigned(F.col("hi"), 64 - (shards.bit_length() - 1)).cast("int").alias("shard")


def _keys(table: pa.Table) -> np.ndarray:
    """64-bit hashes for a filter: the leading bits are the same all over a shard."""
    return table.column("lo").to_numpy().astype(np.int64)


def _filter_of(stored: pa.Table) -> CuckooFilter:
    if not len(stored):
        return CuckooFilter()
    return CuckooFilter.loaded(stored.column("slots")[0].as_py(), stored.column("rest")[0].as_py())


def _filled(shard: int, held: CuckooFilter, add: pa.Table | None = None, remove: pa.Table | None = None) -> pa.Table:
    if remove is not None and len(remove):
        held.remove(_keys(remove))
    if add is not None and len(add):
        held.add(_keys(add))
    slots, rest = held.stored()
    return pa.table({"shard": pa.array([shard], pa.int32()), "slots": pa.array([slots], pa.binary()), "rest": pa.array([rest], pa.binary())})


def _probe(keys: pa.Table, stored: pa.Table) -> pa.Table:
    seen = _filter_of(stored).has(_keys(keys)) if len(keys) else np.empty(0, bool)
    return keys.select([*KEY, "docs", "owner"]).append_column("seen", pa.array(seen, pa.bool_()))


def _changed(shard, changes: pa.Table, stored: pa.Table) -> pa.Table:
    add = changes.column("add").to_numpy(zero_copy_only=False).astype(bool)
    return _filled(shard[0].as_py(), _filter_of(stored), changes.filter(pa.array(add)), changes.filter(pa.array(~add)))
