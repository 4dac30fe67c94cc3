"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.session import ensure_semantics, shared_dir

#: Rows in one Arrow batch at most. Texts may be long, so batches are kept
#: small; every row is still processed, in more batches.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: UTC and ANSI, and Arrow batches
    of at most ``BATCH_ROWS`` rows (a smaller setting of the caller stays)."""
    ensure_semantics(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read back. A lost executor
    costs at most a reread, and no step runs twice."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables made by :func:`written` that nothing reads any more."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fold(column, folds: int):
    """crc32 of the id as text, modulo ``folds`` (null ids: -1)."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % F.lit(folds), F.lit(-1))


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash; holds ``limit`` words at most, so memory
    stays bounded however many different words a task meets."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def ascii_words(text: str | None) -> list[bytes]:
    """Words: runs without space and \\x09-\\x0D (``bytes.split`` separates at
    exactly these six bytes; str.split would also cut at Unicode spaces)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each window of ``size`` consecutive word hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mix(out ^ hashes[k : k + n]) + np.uint64(k + 1)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), elementwise."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(batch) -> dict of columns`` over Arrow batches."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = fn(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[f.name], type=f.type) for f in target], schema=target
            )

    return df.mapInArrow(run, schema)


def matrices(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length of the vectors in column ``q`` -> (rows of the table, their vectors)."""
    lists = table.column("q").combine_chunks()
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    sizes = np.diff(ends)
    return {int(d): (rows := np.flatnonzero(sizes == d), flat[(ends[rows] - ends[0])[:, None] + np.arange(d)]) for d in np.unique(sizes)}
