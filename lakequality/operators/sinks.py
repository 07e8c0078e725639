"""Batch writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakequality import schemas
from lakequality.operators.bronze import kafka_headers
from lakequality.operators.quality import with_side
from lakequality.operators.rules import RuleSet

MAX_RECORDS_PER_FILE = 1_000_000


def write_partitioned(
    df: DataFrame,
    path: str,
    *,
    mode: str = "append",
    partitions: Sequence[str] = tuple(schemas.BRONZE_PARTITIONS),
    format: str = "parquet",
    compression: str = "snappy",
    max_records_per_file: int = 0,
) -> int:
    """Write a layer and return how many rows went out, counted while writing."""
    seen = Observation()
    writer = (
        df.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.mode(mode)
        .format(format)
        .option("compression", compression)
        .partitionBy(*partitions)
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)
    return seen.get["n"]


def write_report(written: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows per written partition."""
    return written.groupBy(*partitions).agg(F.count(F.lit(1)).alias("n"))


def save_table(
    df: DataFrame,
    table: str,
    *,
    mode: str = "append",
    partitions: Sequence[str] = (),
    path: str | None = None,
    format: str = "parquet",
) -> None:
    """Save as a catalog table; with `path` the table is external."""
    writer = df.write.mode(mode).format(format)
    if partitions:
        writer = writer.partitionBy(*partitions)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_split(
    df: DataFrame, rules: RuleSet, path: str, *, mode: str = "append"
) -> tuple[DataFrame, DataFrame]:
    """Check a batch once and write both sides, partitioned by side; returns good and quarantine."""
    with_side(df, rules).write.mode(mode).partitionBy("quarantined").parquet(path)
    written = df.sparkSession.read.parquet(path)
    # Folder names are text; comparing them as such lets Spark skip the other side's folder.
    return (
        written.filter("quarantined = 'false'").drop("quarantined"),
        written.filter("quarantined = 'true'").drop("quarantined"),
    )


def export_report(report: DataFrame, path: str) -> None:
    """A report of a few rows as JSON in one file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_messages(messages: DataFrame, topic: str, servers: str, **options: str) -> None:
    """Send (key, value, headers) rows to a log; needs the Kafka connector on the classpath."""
    (
        messages.withColumn("headers", kafka_headers(F.col("headers")))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .options(**options)
        .save()
    )
