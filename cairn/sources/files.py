
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_records(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """JSON landing scan with a fixed schema (never inferred).

    ``multiline=True`` reads files that hold one JSON array or one object
    (what the API client writes); each such file is a single task because it
    cannot be split, so large landings should arrive as NDJSON
    (``multiline=False``), which Spark splits by byte range.
    Fields missing from a record read as NULL; unknown fields are ignored.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if multiline:
        reader = reader.option("multiLine", True)
    return reader.json(list(path) if not isinstance(path, str) else path)


def landed_shapes(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(files that hold one JSON array or object, as the API client saves them;
    files with one record a line). Told for each file by its first line that is
    not blank; the lines stay in the tasks, only file names reach the driver.

    The lines themselves are never aggregated, so none is sorted or kept: a line is
    tested where it is read, and only the least positions of all lines and of those
    that pass are compared. Arrays are told by a character; the other files are read
    again, and the lines of their first blocks parsed."""

    def first_line(paths: str | list[str], passes: Column, blocks: list[int] | None = None) -> list[Row]:
        lines = spark.read.text(paths).where("trim(value) <> ''")
        placed = lines.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            F.ltrim("value").alias("line"),
        )
        if blocks is not None:
            placed = placed.where(F.col("block").isin(blocks))
        held = placed.groupBy("file", "block").agg(F.min("at").alias("at"), F.min(F.when(passes, F.col("at"))).alias("passed"))
        first = held.groupBy("file").agg(F.min(F.struct("block", "at", "passed")).alias("f"))
        return first.select("file", "f.block", F.expr("f.at <=> f.passed").alias("passes")).collect()

    arrays, rest = [], []
    for r in first_line(path, F.startswith("line", F.lit("["))):
        (arrays if r["passes"] else rest).append(r)
    # a record that goes on in the next line is no document by itself
    whole = F.get_json_object("line", "$").isNotNull()
    found = first_line([r["file"] for r in rest], whole, sorted({r["block"] for r in rest})) if rest else []
    objects, by_line = ([r["file"] for r in found if r["passes"] is held] for held in (False, True))
    return sorted([r["file"] for r in arrays] + objects), sorted(by_line)


def read_landed(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """A landing folder or file, its files of any shape, with its order columns:
    ``batch_seq`` is the batch, ``file_seq`` the file's name, ``block_seq`` where the
    block that a task read begins in it, and ``row_seq`` rises within the block. So
    the order is that of the files' names and of the records in them, however
    Spark splits and packs the files. Empty if nothing landed there."""
    order = {
        "batch_seq": F.lit(batch_id).cast("bigint"),
        "file_seq": F.col("_metadata.file_name"),
        "block_seq": F.col("_metadata.file_block_start"),
        "row_seq": F.monotonically_increasing_id(),
    }
    documents, lines = landed_shapes(spark, path) if path_exists(spark, path) else ([], [])
    parts = [read_json_records(spark, files, schema, multiline=one).withColumns(order) for files, one in ((documents, True), (lines, False)) if files]
    if not parts:
        nothing = T.StructType([T.StructField("batch_seq", T.LongType()), T.StructField("file_seq", T.StringType()), T.StructField("block_seq", T.LongType()), T.StructField("row_seq", T.LongType())])
        return spark.createDataFrame([], T.StructType([*schema.fields, *nothing.fields]))
    return reduce(DataFrame.unionByName, parts)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union relations by column name; a column missing on one side is NULL.

    Names match case-insensitively and numeric types widen (INT + BIGINT ->
    BIGINT), which Parquet ``mergeSchema`` refuses. The first frame's
    spelling of a name wins.
    """
    if not frames:
        raise ValueError("union_by_name needs at least one relation")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_union_by_name(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``read_parquet([...], union_by_name=true)``: one scan per file set,
    unioned by name (no data moves; the union is a narrow concatenation)."""
    return union_by_name([spark.read.parquet(p) for p in paths])


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, bool]:
    """Read a history table, or start from an empty typed table.

    Only a missing path counts as a first run; any other failure (access,
    corrupt files, schema clash) raises instead of silently starting over.
    Returns ``(frame, first_run)``.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema), True
    try:
        return spark.read.schema(schema).parquet(path), False
    except AnalysisException as exc:  # an empty directory has no files to read
        if "UNABLE_TO_INFER_SCHEMA" in str(exc) or "PATH_NOT_FOUND" in str(exc):
            return spark.createDataFrame([], schema), True
        raise
