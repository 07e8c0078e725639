"""Loads: appends with an id, a manifest of what each one wrote, and no repeat when it is delivered again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequality import schemas

# Readers of the table skip folders that begin with an underscore.
_LOADS = "_loads"
_DONE = "_DONE"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def _folder(path: str, load_id: str) -> str:
    if not load_id or not all(c.isalnum() or c in "-_." for c in load_id) or load_id[0] in "._":
        raise ValueError(f"a load id is a folder name of letters, digits, dots and dashes: {load_id!r}")
    return f"{path.rstrip('/')}/{_LOADS}/{load_id}"


def write_load(
    df: DataFrame,
    path: str,
    load_id: str,
    partitions: Sequence[str] = tuple(schemas.BRONZE_PARTITIONS),
    *,
    max_records_per_file: int = 0,
) -> DataFrame:
    """Append a load to a partitioned folder and return its manifest.

    Rows are written to a folder of the load that readers of the table skip, counted there by file
    (from what this write produced, whatever else is in the table), and the files are moved into the
    table. The manifest is stored before the first move. A load that broke off is finished, not
    repeated, when it is written again: before the manifest it starts anew, after it only the missing
    moves are made. A finished load is left alone and its manifest returned. Two writers must not
    write one load id at the same time; loads of different ids don't meet.
    """
    spark = df.sparkSession
    home = _folder(path, load_id)
    if not _exists(spark, f"{home}/{_DONE}"):
        if not _exists(spark, f"{home}/manifest/_SUCCESS"):
            _stage(df, home, partitions, max_records_per_file)
        publish(spark, path, load_id)
    return manifest(spark, path, load_id)


def _stage(df: DataFrame, home: str, partitions: Sequence[str], max_records_per_file: int) -> None:
    spark = df.sparkSession
    staged = f"{home}/staged"
    writer = df.write.mode("overwrite")
    if partitions:
        writer = writer.partitionBy(*partitions)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(staged)
    # Only footers are read: no column is asked for but those in folder names.
    written = spark.read.schema(df.schema).parquet(staged)
    at = F.col("_metadata")
    files = written.groupBy(*partitions, at["file_path"].alias("__file")).agg(
        F.count(F.lit(1)).alias("n"), F.max(at["file_size"]).alias("bytes")
    )
    name = F.regexp_extract("__file", "/staged/(.*)$", 1).alias("file")
    files.select(*partitions, name, "n", "bytes").coalesce(1).write.mode("overwrite").parquet(f"{home}/manifest")


def publish(spark: SparkSession, path: str, load_id: str) -> int:
    """Move the files of a staged load into the table; returns how many this call moved.

    One move for each file, as Spark's own commit makes them. A file that is in the table already was
    moved by an earlier call. Names hold the write's own id, so files of other loads are never met.
    """
    home = _folder(path, load_id)
    jvm = spark._jvm
    fs, _ = _fs(spark, path)
    moved = 0

    def place(folder: str, name: str):
        # Names are kept as URIs, in which folder names with signs are escaped once more.
        return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(jvm.org.apache.hadoop.fs.Path(folder).toUri().toString() + "/" + name))

    for row in manifest_files(spark, path, load_id).select("file").toLocalIterator():
        source, target = place(f"{home}/staged", row.file), place(path.rstrip("/"), row.file)
        if fs.exists(source):
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"{source} could not be moved to {target}")
            moved += 1
        elif not fs.exists(target):
            raise FileNotFoundError(f"load {load_id}: {row.file} is neither staged nor in the table")
    fs.create(jvm.org.apache.hadoop.fs.Path(f"{home}/{_DONE}"), True).close()
    fs.delete(jvm.org.apache.hadoop.fs.Path(f"{home}/staged"), True)
    return moved


def manifest_files(spark: SparkSession, path: str, load_id: str) -> DataFrame:
    """Every file of a load: partition values, name below the table, rows and bytes."""
    return spark.read.parquet(f"{_folder(path, load_id)}/manifest")


def manifest(spark: SparkSession, path: str, load_id: str) -> DataFrame:
    """Files, rows and bytes that a load wrote, per partition; a load without rows has none."""
    listed = manifest_files(spark, path, load_id)
    keys = [name for name in listed.columns if name not in ("file", "n", "bytes")]
    return listed.groupBy(*keys).agg(
        F.lit(load_id).alias("load_id"), F.count(F.lit(1)).alias("files"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes")
    )


def loads(spark: SparkSession, path: str) -> DataFrame:
    """Every load of a table and whether it is finished, from folder names."""
    fs, at = _fs(spark, f"{path.rstrip('/')}/{_LOADS}")
    rows = []
    for status in fs.listStatus(at) if fs.exists(at) else []:
        home = status.getPath().toString()
        state = "finished" if _exists(spark, f"{home}/{_DONE}") else "staged" if _exists(spark, f"{home}/manifest/_SUCCESS") else "begun"
        rows.append((status.getPath().getName(), state))
    return spark.createDataFrame(rows, "load_id STRING, state STRING")
