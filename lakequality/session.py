"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# HotSpot compiles no method beyond 8000 bytes of bytecode. Wide rows with many rules reach that in
# one generated method, which then runs interpreted; below the limit Spark uses smaller methods.
HOTSPOT_METHOD_LIMIT = "8000"

# Streaming state that may outgrow executor memory is kept in RocksDB, which spills to disk.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Tasks that list the folders or files of a read. By default Spark takes one for each path, so a batch of a thousand small
# files costs a thousand tasks before it is read.
LISTING_TASKS = "64"

# For tables and streams of whole messages: their JSON repeats its field names in every row.
COMPRESSION = "zstd"

# Timestamps in the files of tables of whole rows: as numbers, not in Spark's older form of 12 bytes,
# which has no bounds and costs a dictionary look-up by bytes.
LONG_TIMESTAMPS = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}

SQL_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": HOTSPOT_METHOD_LIMIT,
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": LISTING_TASKS,
}


# For joins of the sample tables. A row then meets rules, casts and JSON, which take far longer than to
# read it, so tasks of fewer shuffled bytes than Spark's 64 MB fill the cores more evenly. A side of a
# join that stays below that in every task is held as a hash table there; a larger one is sorted.
TASK_BYTES = "16m"
JOIN_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": TASK_BYTES,
}


def prepare(spark: SparkSession, **more: str) -> SparkSession:
    """Apply the SQL settings, and more if given, to a session made elsewhere."""
    for key, value in {**SQL_SETTINGS, **more}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def with_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """SQL settings for the length of a block; afterwards they are as they were."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def get_session(app: str = "lakequality", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **SQL_SETTINGS,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, which every executor can reach.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lakequality-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/lakequality/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, so lost executors cost no re-run and every reader sees the same rows.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
