"""Checkpoints of streams: faults found before a start, copies to go back to."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The folders of a checkpoint, and the first line of a log file.
_LOGS = ("offsets", "commits")
_VERSION = "v1"

_FAULTS = "place STRING, fault STRING"


class CheckpointError(RuntimeError):
    """A checkpoint that a stream must not start from."""

    def __init__(self, path: str, faults: list):
        self.faults = faults
        super().__init__(f"checkpoint {path}: " + "; ".join(f"{row.place}: {row.fault}" for row in faults))


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> dict[str, int]:
    """Files and folders in a folder of a checkpoint, with their bytes; Spark keeps some hundred."""
    fs, at = _fs(spark, path)
    return {s.getPath().getName(): s.getLen() for s in fs.listStatus(at)} if fs.exists(at) else {}


def log_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The log files of a checkpoint: log, batch, and whole text."""
    schema = "log STRING, batch BIGINT, text STRING"
    found, empty = spark.createDataFrame([], schema), []
    for log in _LOGS:
        sizes = {name: size for name, size in _names(spark, f"{checkpoint}/{log}").items() if name.isdigit()}
        empty += [(log, int(name), "") for name, size in sizes.items() if not size]  # readers skip empty files
        if any(sizes.values()):
            text = spark.read.text(f"{checkpoint}/{log}", wholetext=True, pathGlobFilter="[0-9]*")
            batch = F.col("_metadata.file_name").cast("bigint").alias("batch")
            found = found.unionByName(text.select(F.lit(log).alias("log"), batch, F.col("value").alias("text")))
    return found.unionByName(spark.createDataFrame(empty, schema))


def _is_json(line) -> F.Column:
    return F.try_parse_json(line).isNotNull()


def faults(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What is wrong with a checkpoint: `place` and `fault`, no rows when it is sound or not begun.

    Found are: log files that are empty, cut or no JSON, of an unknown version, or with another
    number of sources than the rest; batches missing between others; commits without their offsets;
    more than one batch without a commit; a missing or broken `metadata` file beside logs.
    """
    files = log_files(spark, checkpoint).withColumn("lines", F.split(F.rtrim("text"), "\\n"))
    body = F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))
    # A source without an offset yet is written as a dash.
    broken = F.exists(body, lambda line: (line != "-") & ~_is_json(line))
    place = F.concat_ws("/", "log", "batch")
    fault = (
        F.when(F.length(F.trim("text")) == 0, "empty")
        .when(F.element_at("lines", 1) != _VERSION, "unknown version")
        .when(F.size(body) == 0, "cut")
        .when((F.col("log") == "offsets") & (F.size(body) < 2), "cut")
        .when(broken, "no JSON")
    )
    # Each batch is one row of both logs; gaps are counted, not searched.
    texts = files.select(place.alias("place"), fault.alias("fault")).filter("fault IS NOT NULL")
    numbers = files.groupBy("log").agg(F.min("batch").alias("first"), F.max("batch").alias("last"), F.count(F.lit(1)).alias("n"))
    gaps = numbers.filter("last - first + 1 <> n").select(F.col("log").alias("place"), F.lit("batches missing").alias("fault"))
    sides = files.groupBy("batch").agg(
        F.count_if(F.col("log") == "offsets").alias("offsets"), F.count_if(F.col("log") == "commits").alias("commits")
    )
    # Old batches are purged from both logs, one after the other, so the oldest may be in one only.
    first = sides.filter("offsets > 0").agg(F.coalesce(F.min("batch"), F.lit(-1))).scalar()
    orphans = sides.filter((F.col("commits") > 0) & (F.col("offsets") == 0) & (F.col("batch") > first)).select(
        F.concat(F.lit("commits/"), "batch").alias("place"), F.lit("no offsets of this batch").alias("fault")
    )
    pending = sides.filter("offsets > 0 AND commits = 0").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        F.lit("commits").alias("place"), F.lit("more than one batch without a commit").alias("fault")
    )
    widths = files.filter("log = 'offsets' AND text <> ''").agg(F.count_distinct(F.size("lines")).alias("n")).filter("n > 1").select(
        F.lit("offsets").alias("place"), F.lit("number of sources changes").alias("fault")
    )
    found = texts.unionByName(gaps).unionByName(orphans).unionByName(pending).unionByName(widths)
    head = _metadata_fault(spark, checkpoint)
    if head:
        found = found.unionByName(spark.createDataFrame([("metadata", head)], _FAULTS))
    return found


def _metadata_fault(spark: SparkSession, checkpoint: str) -> str | None:
    names = _names(spark, checkpoint)
    if "metadata" not in names:
        begun = any(any(n.isdigit() for n in _names(spark, f"{checkpoint}/{log}")) for log in _LOGS)
        return "missing" if begun else None
    if not names["metadata"]:
        return "empty"
    text = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()
    try:
        return None if text and json.loads(text[0]).get("id") else "no query id"
    except (ValueError, AttributeError):
        return "no JSON"


def check(spark: SparkSession, checkpoint: str) -> None:
    """Raise CheckpointError when a stream must not start from this checkpoint."""
    found = faults(spark, checkpoint).orderBy("place", "fault").collect()
    if found:
        raise CheckpointError(checkpoint, found)


def save(spark: SparkSession, checkpoint: str, to: str) -> None:
    """Copy a sound checkpoint of a stream that is stopped; an existing copy is left alone.

    The copy appears under its name when it is whole, so a break never leaves half of one.
    """
    check(spark, checkpoint)
    _copy(spark, checkpoint, to)


def restore(spark: SparkSession, saved: str, checkpoint: str) -> None:
    """Put a saved checkpoint in the place of a broken one, which is kept beside it as `.broken`.

    Batches that ran since the copy run again. A sink that replaces its batches (`write_batch`) or
    logs them (the file sink) then holds every row once.
    """
    check(spark, saved)
    fs, at = _fs(spark, checkpoint)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}.broken")
    if fs.exists(at):
        if fs.exists(aside):
            raise FileExistsError(f"{aside} is in the way")
        if not fs.rename(at, aside):
            raise OSError(f"{checkpoint} could not be set aside")
    _copy(spark, saved, checkpoint)


def _copy(spark: SparkSession, source: str, target: str) -> None:
    fs, from_path = _fs(spark, source)
    to_fs, to_path = _fs(spark, target)
    if to_fs.exists(to_path):
        raise FileExistsError(f"{target} exists")
    hadoop = spark._jvm.org.apache.hadoop.fs
    half = hadoop.Path(f"{target.rstrip('/')}.part")
    to_fs.delete(half, True)
    hadoop.FileUtil.copy(fs, from_path, to_fs, half, False, True, spark._jsc.hadoopConfiguration())
    if not to_fs.rename(half, to_path):
        raise OSError(f"{target} could not be put in place")


def cut(spark: SparkSession, path: str, n_bytes: int) -> None:
    """Leave only the first bytes of a log file, as a writer that died would; for trials of the above."""
    fs, at = _fs(spark, path)
    kept = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, n_bytes)).first()[0]
    out = fs.create(at, True)
    out.write(bytearray(kept))
    out.close()
