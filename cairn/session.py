"""SparkSession defaults shared by tests, bench and the pipeline.

A cluster deployment passes its own session in; these helpers only fill in
settings that are unset, so a cluster's ``spark.checkpoint.dir``, shuffle
sizing and memory settings always win.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings the pipeline relies on for correct results (not tuning):
#   UTC session zone  -> date_trunc / hour / casts agree with naive-UTC data
#   ANSI mode         -> malformed casts and overflows raise instead of NULL
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Tuning defaults for a local run. On a cluster size shuffle partitions to
# roughly (shuffle bytes / 128 MB) and let AQE coalesce and split skew.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # No broadcast from plan-time estimates (a compressed file size is not a
    # bound on a hashed relation); AQE broadcasts a join side only after its
    # shuffle stage has run and measured it. Explicit broadcasts in the code
    # sit behind exact row-count checks.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "cairn", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; never used on a cluster."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**LOCAL_CONF, **SEMANTIC_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.driver.memory", os.environ.get("CAIRN_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_semantics(spark)
    return spark


def ensure_semantics(spark: SparkSession) -> None:
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written tables.

    Reads ``spark.checkpoint.dir`` (the cluster names it). Where it is unset, a
    local session that names a scratch folder in ``CAIRN_SCRATCH`` gets a fresh
    folder there, removed when the process ends; anything else raises, as
    executors would write to their own disks.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        scratch = os.environ.get("CAIRN_SCRATCH")
        if not scratch or not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="cairn-ckpt-", dir=scratch)
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")
