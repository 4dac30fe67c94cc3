"""Write derived landing files (what the API client would have saved)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import ingest
from cairn.sources import fixtures


# Fixed value: records of a landed NDJSON file at most.
NDJSON_RECORDS = 200_000


def write_ndjson(df: DataFrame, path: str, per_file: int = NDJSON_RECORDS) -> str:
    """NDJSON by gzip, a tenth of the text or less. Such a file is read by one task,
    record by record, so a file ends after ``per_file`` records."""
    df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", per_file).json(path)
    return path


# Fixed value: records of a landed array file at most. A reader parses an array as
# one, so this bounds what its task holds, however many records a writer's task has.
ARRAY_RECORDS = 50_000


def write_arrays(df: DataFrame, path: str, per_file: int = ARRAY_RECORDS) -> str:
    """Indented JSON arrays, as the API client saves them, one a file. An array ends
    after ``per_file`` records; each record is one row of the text, so that the
    writer begins its next file at the same place."""

    def lines(batches):
        import pyarrow as pa

        n, last = 0, None  # the last record waits until its end is known
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                new = n % per_file == 0
                if last is not None:
                    out.append(last + "\n]" if new else last)
                last = ("[" if new else ",") + "\n  " + text
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if last is None else last + "\n]"])], names=["value"])

    texts = df.select(F.to_json(F.struct("*")).alias("value")).mapInArrow(lines, "value string")
    texts.write.mode("overwrite").option("maxRecordsPerFile", per_file).text(path)
    return path


def write_activity_batches(spark: SparkSession, sf_dir: str, root: str) -> list[str]:
    """Each landed fetch in its own folder, fetch 1 written first."""
    landed = fixtures.activity_batches(spark, sf_dir)
    paths = []
    for seq in (1, 2):
        paths.append(write_ndjson(landed.where(F.col("batch_seq") == F.lit(seq)), f"{root}/activities/fetch={seq}"))
    return paths


def landed_tables(spark: SparkSession, sf_dir: str, seq: int) -> dict[str, DataFrame]:
    """The five files of one fetch as the API client saves them: no order
    columns, children with their parent's key, totals per athlete."""
    landed = fixtures.activity_batches(spark, sf_dir).where(F.col("batch_seq") == F.lit(seq))
    fetches = fixtures.child_fetches(ingest.child_worklist(landed))
    comments = ingest.stamp_comments(fetches).selectExpr(
        "id", "text", "created_at", "named_struct('firstname', firstname, 'lastname', lastname) AS athlete", "activity_id"
    )
    totals = ingest.athlete_totals(landed).selectExpr(
        "athlete_id",
        *[
            f"named_struct({', '.join(f"'{m}', {kind}_{m}" for m in ingest.TOTAL_FIELDS)}) AS all_{kind}_totals"
            for _, kind in ingest.TOTAL_TYPES
        ],
    )
    return {
        "activities": landed.drop("batch_seq", "row_seq"),
        "comments": comments,
        "kudos": ingest.stamp_kudos(fetches).select("activity_id", "firstname", "lastname", "resource_state"),
        "stats": totals,
        "athlete": fixtures.athletes_from_customers(fixtures.read_table(spark, sf_dir, "customer")),
    }


def write_landings(spark: SparkSession, sf_dir: str, root: str, names=("activities", "comments", "kudos", "stats", "athlete"), seqs=(1, 2)) -> list[str]:
    """``<root>/fetch=<n>/<name>`` with array files; the folders of the fetches."""
    for seq in seqs:
        tables = landed_tables(spark, sf_dir, seq)
        for name in names:
            write_arrays(tables[name], f"{root}/fetch={seq}/{name}")
    return [f"{root}/fetch={seq}" for seq in seqs]
