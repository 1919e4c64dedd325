"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Applied only where the caller has set nothing.
DEFAULTS = {
    # Split a skewed join partition even if that costs one more shuffle later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows with whole texts: smaller batches between the JVM and Python keep both sides small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}

# For the table work, where the caller has set nothing: a task's share of a scan or a shuffle keeps its size
# as the tables grow, whatever ``spark.sql.shuffle.partitions`` says; adaptive execution merges small ones.
TABLE_DEFAULTS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "32m",
    # Each task counts a broadcast table, which may take 80 times the bytes of its files; larger sides are shuffled.
    "spark.sql.autoBroadcastJoinThreshold": "1m",
}


def build_session(app: str = "cohorta", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    return _set_defaults(spark, DEFAULTS)


def tune_tables(spark: SparkSession) -> SparkSession:
    """``tune``, and tasks of bounded size for joins and groups of the tables."""
    return _set_defaults(tune(spark), TABLE_DEFAULTS)


def _set_defaults(spark: SparkSession, defaults: dict[str, str]) -> SparkSession:
    have = spark.conf.getAll
    for key, value in defaults.items():
        if key not in have:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", "")
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="cohorta-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table that is written once and read back."""
    return f"{shared_dir(spark)}/cohorta/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: later jobs read the written rows and never recompute them."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
