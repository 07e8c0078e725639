"""Old versions of a table: which folders the catalog still reaches, and removal of the others."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequality.operators.maintenance import _partition_keys


def locations(spark: SparkSession, table: str) -> list[str]:
    """The folders that a table reads: one for each partition, or its own."""
    state = spark._jsparkSession.sessionState()
    name = state.sqlParser().parseTableIdentifier(table)
    if not _partition_keys(spark, table):
        return [state.catalog().getTableMetadata(name).location().toString()]
    parts = state.catalog().listPartitions(name, spark._jvm.scala.Option.empty()).iterator()
    found = []
    while parts.hasNext():
        found.append(parts.next().location().toString())
    return found


def _plain(path: Column) -> Column:
    """One spelling of a path: `file:/a`, `file:///a` and a closing slash differ by writer only."""
    return F.regexp_replace(F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/"), "/+$", "")


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """Every data file below a folder with its own folder, bytes and age; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = _plain(F.col("_metadata.file_path"))
    return listed.select(
        path.alias("file"),
        F.regexp_replace(path, "/[^/]*$", "").alias("folder"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _reached(spark: SparkSession, tables: list[str]) -> DataFrame:
    rows = [(place,) for table in tables for place in locations(spark, table)]
    return spark.createDataFrame(rows, "place STRING").select(_plain(F.col("place")).alias("place")).distinct()


def unreferenced(
    spark: SparkSession, tables: list[str], root: str, before: datetime.datetime | None = None
) -> DataFrame:
    """Folders below `root` that no table reads from: files, bytes and newest file of each.

    A folder is reached when a table's location is the folder itself or one above it. With `before`,
    only folders whose files are all older are listed, so versions being written stay out of it.
    """
    folders = stored_files(spark, root).groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.max("modified").alias("newest")
    )
    steps = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    kept = (
        folders.select("folder", F.explode(above).alias("place"))
        .join(_reached(spark, tables), "place", "left_semi")
        .select("folder")
    )
    free = folders.join(kept, "folder", "left_anti")
    return free if before is None else free.filter(F.col("newest") < F.lit(before))


def vacuum(
    spark: SparkSession, tables: list[str], root: str, before: datetime.datetime
) -> DataFrame:
    """Delete folders below `root` that no table reads and whose files are all older than `before`.

    Returns what was deleted. `tables` must name every table that reads below `root`. `before` should
    lie further back than the longest write or query, whose files may not be in the catalog yet or
    any more. Reachability is read again right before deleting, so a switch back to an old version in
    between saves it. Only folder names reach the driver.
    """
    doomed = unreferenced(spark, tables, root, before).collect()
    again = {row["place"] for row in _reached(spark, tables).collect()}
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    top = fs.makeQualified(top)
    gone = []
    for row in doomed:
        folder = row["folder"]
        steps = folder.split("/")
        if again & {"/".join(steps[:n]) for n in range(1, len(steps) + 1)}:
            continue
        at = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder)))
        if any(status.isDirectory() for status in fs.listStatus(at)):
            for status in fs.listStatus(at):  # subfolders are judged on their own
                if status.isFile():
                    fs.delete(status.getPath(), False)
        else:
            fs.delete(at, True)
        gone.append(row)
        _prune(fs, at.getParent(), top)
    for table in tables:
        spark.catalog.refreshTable(table)
    return spark.createDataFrame(gone, "folder STRING, files BIGINT, bytes BIGINT, newest TIMESTAMP")


def _prune(fs, folder, top) -> None:
    """Remove folders that became empty, up to but not including the root."""
    while folder is not None and folder.toString().startswith(top.toString() + "/"):
        if fs.exists(folder):
            left = [status.getPath() for status in fs.listStatus(folder)]
            if any(path.getName() != "_SUCCESS" for path in left):
                return
            fs.delete(folder, True)
        folder = folder.getParent()
