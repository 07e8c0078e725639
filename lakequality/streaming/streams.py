"""Streams between the layers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from lakequality import schemas
from lakequality.operators import bronze as bronze_ops
from lakequality.operators import silver as silver_ops
from lakequality.operators.quality import FAIL, PASS, WARNING, lineage, validate
from lakequality.operators.rules import RuleSet
from lakequality.operators.sinks import MAX_RECORDS_PER_FILE
from lakequality.session import COMPRESSION, LONG_TIMESTAMPS, with_settings

DEFAULT_INTERVAL = "5 seconds"

# Folders a task of a batch keeps open at once. A batch has few dates and hours, so its rows, which
# hold whole messages, need no sort by folder; a task that meets more folders sorts the rest.
OPEN_FOLDERS = "4"
_WRITERS = {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FOLDERS}

# For the time a stream from files to folders runs: its source and its sink read the session's settings
# when a batch is planned, not when the stream starts. Messages shrink to a tenth in a file and grow to
# wide rows in a task, so a task reads less than Spark's 128 MB.
FILE_STREAM_SETTINGS = {**_WRITERS, **LONG_TIMESTAMPS, "spark.sql.files.maxPartitionBytes": "16m"}


def trigger(interval: str | None = None) -> dict:
    """Trigger arguments from text: `available now`, `10 seconds`, `2 minutes`, else 5 seconds."""
    text = (interval or DEFAULT_INTERVAL).strip().lower()
    if text == "available now":
        return {"availableNow": True}
    amount, _, unit = text.partition(" ")
    if amount.isdigit() and unit.rstrip("s") in ("second", "minute"):
        return {"processingTime": text}
    return {"processingTime": DEFAULT_INTERVAL}


def append_stream(
    df: DataFrame,
    checkpoint: str,
    *,
    path: str | None = None,
    table: str | None = None,
    partitions: Sequence[str] = (),
    interval: str | None = None,
    name: str | None = None,
    format: str = "parquet",
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> StreamingQuery:
    """Append a stream to a folder or a catalog table."""
    writer = (
        df.writeStream.format(format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", max_records_per_file)
        .trigger(**trigger(interval))
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    if name:
        writer = writer.queryName(name)
    return writer.toTable(table) if table else writer.start(path)


def log_to_bronze(log: DataFrame, *, at: Column | None = None, **context) -> DataFrame:
    """The stream of a message log as Bronze rows."""
    return bronze_ops.to_bronze(log, at=at, **context)


def bronze_to_silver(
    bronze: DataFrame,
    payload: schemas.Payload,
    fill: Callable[[DataFrame], DataFrame],
    rules: RuleSet,
    ddl: str,
    *,
    at: Column | None = None,
    lineage_id: Column | None = None,
) -> DataFrame:
    """Bronze to Silver with quality columns.

    Parsing, defaults, rules and metadata are projections: no shuffle and no state, so a stream
    keeps the parallelism of its source and restarts from offsets alone.
    """
    parsed = fill(silver_ops.parse_payload(bronze, payload))
    checked = validate(parsed, rules, at=at, lineage_id=lineage_id)
    return silver_ops.conform(silver_ops.add_silver_metadata(checked, at), ddl)


def weather_to_silver(bronze: DataFrame, rules: RuleSet, **options) -> DataFrame:
    return bronze_to_silver(
        bronze,
        schemas.WEATHER_PAYLOAD,
        silver_ops.fill_weather,
        rules,
        schemas.SILVER_WEATHER_QUALITY,
        **options,
    )


def orders_to_silver(bronze: DataFrame, rules: RuleSet, **options) -> DataFrame:
    return bronze_to_silver(
        bronze,
        schemas.ORDER_PAYLOAD,
        silver_ops.fill_orders,
        rules,
        schemas.SILVER_ORDERS_QUALITY,
        **options,
    )


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def write_batch(
    batch: DataFrame, batch_id: int, path: str, *, partitions: Sequence[str] = (), **counts: Column
) -> dict:
    """Write one micro-batch to a folder of its own and return counts taken on the way.

    A batch that is replayed after a failure replaces its folder, so nothing appears twice.
    """
    seen = Observation()
    observed = batch.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(condition).alias(name) for name, condition in counts.items()),
    )
    writer = observed.write.mode("overwrite").option("compression", COMPRESSION)
    if partitions:
        writer = writer.partitionBy(*partitions)
    with with_settings(batch.sparkSession, _WRITERS):
        writer.parquet(batch_folder(path, batch_id))
    return seen.get


def bronze_batches(
    bronze: DataFrame,
    path: str,
    metrics_path: str,
    checkpoint: str,
    *,
    interval: str | None = None,
) -> StreamingQuery:
    """Order Bronze rows per micro-batch, with a metrics row (rows, flagged invalid) per batch."""
    flagged = F.lower("is_valid") == "false"

    def process(batch: DataFrame, batch_id: int) -> None:
        counts = write_batch(
            batch, batch_id, path, partitions=schemas.BRONZE_PARTITIONS, quality_issues=flagged
        )
        row = [(batch_id, counts["n"], counts["quality_issues"])]
        (
            batch.sparkSession.createDataFrame(row, "batch BIGINT, n BIGINT, quality_issues BIGINT")
            .coalesce(1)
            .write.mode("overwrite")
            .parquet(batch_folder(metrics_path, batch_id))
        )

    return _for_each(bronze, process, checkpoint, interval)


def validated_batches(
    df: DataFrame,
    rules: RuleSet,
    path: str,
    checkpoint: str,
    *,
    pipeline: str = "silver",
    interval: str | None = None,
) -> StreamingQuery:
    """Validate each micro-batch once and write it partitioned by flag.

    Failed rows are the `quality_flag=FAIL` folders. The lineage id comes from the batch id, so a
    replayed batch is stamped alike and replaces its own folder.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        checked = validate(batch, rules, lineage_id=lineage(pipeline, batch_id))
        write_batch(checked, batch_id, path, partitions=["quality_flag"])

    return _for_each(df, process, checkpoint, interval)


def quality_metric_batches(
    validated: DataFrame, path: str, checkpoint: str, *, interval: str | None = None
) -> StreamingQuery:
    """A metrics row per micro-batch of validated rows."""

    def process(batch: DataFrame, batch_id: int) -> None:
        flags = {"passed": PASS, "warned": WARNING, "failed": FAIL}
        (
            batch.agg(
                F.count(F.lit(1)).alias("total_records"),
                *(
                    F.count_if(F.col("quality_flag") == flag).alias(f"{name}_records")
                    for name, flag in flags.items()
                ),
                F.sum("failed_rules").alias("broken_rules"),
            )
            .write.mode("overwrite")
            .parquet(batch_folder(path, batch_id))
        )

    return _for_each(validated, process, checkpoint, interval)


def bronze_copy(df: DataFrame, path: str, checkpoint: str, *, interval: str | None = None) -> StreamingQuery:
    """Each micro-batch as it is, in a folder of its own, which a replay replaces."""
    return _for_each(df, lambda batch, batch_id: batch.write.mode("overwrite").parquet(batch_folder(path, batch_id)), checkpoint, interval)


def batch_evidence(
    df: DataFrame, path: str, checkpoint: str, *, interval: str | None = None
) -> StreamingQuery:
    """Write each micro-batch of a file stream, and beside it what the batch took in.

    The rows go to `path`/rows; `path`/admitted has a row for every file of every batch: its name,
    bytes and rows. Both have a folder for each batch, which a replay replaces.
    """
    at = F.col("_metadata")
    tagged = df.select("*", at["file_path"].alias("__file"), at["file_size"].alias("__bytes"))

    def process(batch: DataFrame, batch_id: int) -> None:
        rows = batch_folder(f"{path}/rows", batch_id)
        batch.write.mode("overwrite").parquet(rows)
        # Counted from what was written, so the source is read once.
        written = batch.sparkSession.read.schema(batch.schema).parquet(rows)
        admitted = written.groupBy(F.col("__file").alias("file"), F.col("__bytes").alias("bytes")).agg(F.count(F.lit(1)).alias("n"))
        admitted.write.mode("overwrite").parquet(batch_folder(f"{path}/admitted", batch_id))

    return _for_each(tagged, process, checkpoint, interval)


def quarantined_batches(
    df: DataFrame, bad: Column, path: str, checkpoint: str, *, source: str, reason: str = "corrupt record", interval: str | None = None
) -> StreamingQuery:
    """Write each micro-batch once, split into good rows and dead letters.

    Rows where `bad` is true become dead letters, with the reason, the name of their source and the
    batch beside all they hold. A replayed batch replaces its folders, so both sides stay in step.
    Read them back with `good_rows` and `dead_letters`.
    """
    dead = F.coalesce(bad, F.lit(False))

    def process(batch: DataFrame, batch_id: int) -> None:
        sided = batch.withColumns(
            {
                "dead_letter": dead,
                "dead_letter_reason": F.when(dead, F.lit(reason)),
                "dead_letter_source": F.when(dead, F.lit(source)),
            }
        )
        write_batch(sided, batch_id, path, partitions=["dead_letter"])

    return _for_each(df, process, checkpoint, interval)


def good_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What `quarantined_batches` let through, in the columns of `schema`."""
    # Folder names are text; comparing them as such lets Spark skip the other side's folders.
    return _sides(spark, path, schema).filter("dead_letter = 'false'").select(schema.names)


def dead_letters(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What it held back, with reason, source and batch."""
    added = ["dead_letter_reason", "dead_letter_source", "batch_id"]
    return _sides(spark, path, schema).filter("dead_letter = 'true'").select(*schema.names, *added)


def _sides(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    folders = "dead_letter_reason STRING, dead_letter_source STRING, batch_id BIGINT, dead_letter STRING"
    return spark.read.schema(T.StructType(schema.fields + T._parse_datatype_string(folders).fields)).parquet(path)


def running_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows seen so far per key: the state holds one counter per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def changelog(
    df: DataFrame, path: str, checkpoint: str, *, interval: str | None = None
) -> StreamingQuery:
    """The changed rows of an aggregation, one folder per micro-batch."""

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return _for_each(df, process, checkpoint, interval, mode="update")


def _for_each(df, process, checkpoint, interval, mode="append") -> StreamingQuery:
    return (
        df.writeStream.outputMode(mode)
        .foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(interval))
        .start()
    )
