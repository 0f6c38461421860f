"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. All can be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even if the aggregation above the join then
    # needs one more shuffle: a single task with a third of all rows costs more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    # Rows with long texts: batches for Python stay at some megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# For scans of many small files that are not read again: some thousand in a task, no states of files kept in the driver after
# the scan, and no code made for each file (the image reader makes a serializer per file; most of its time went there).
SMALL_FILE_SETTINGS = {
    "spark.sql.files.openCostInBytes": "64k",
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
    "spark.sql.codegen.factoryMode": "NO_CODEGEN",
}


def for_small_files(spark: SparkSession) -> SparkSession:
    """A session beside the given one, with its settings but for those of small files."""
    session = spark.newSession()
    for key, value in (spark.conf.getAll | SMALL_FILE_SETTINGS).items():
        if session.conf.get(key, None) != value:
            session.conf.set(key, value)
    return session


# Wanted size of a shuffle partition.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, cores: int = 1) -> int:
    """A good ``spark.sql.shuffle.partitions`` for an input: about 128 MB each and
    at least one per core. Set it when the session is built; no query changes it."""
    return max(cores, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app: str = "tallyspark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the runtime settings.

    ``shuffle_partitions`` is the *initial* number; adaptive execution merges
    small ones, so on a cluster leave it high (some multiple of the cores).
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables, stream state and checkpoints.

    Taken from ``spark.checkpoint.dir``. Only a session within one process may
    fall back to a temporary folder; other executors could not see it. What is
    below belongs to the session: remove the folder when it ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="tallyspark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the work folder that nobody has used before."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, split_bytes: int | None = None) -> DataFrame:
    """The rows from a Parquet table in the work folder.

    What follows reads the table and not the steps that made it, so a lost
    executor costs a read, and a table used twice is computed once. With
    ``split_bytes`` row groups are that large, so that many tasks can share a
    file: for tables that are read often and with much work per row.
    """
    path = fresh_dir(df.sparkSession, label)
    writer = df.write if split_bytes is None else df.write.option("parquet.block.size", split_bytes)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
