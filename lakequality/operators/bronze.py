"""From log messages to Bronze rows, and from rows to log messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequality.functions.scalars import date_parts, epoch_text, partition_key

# Business fields repeated next to the raw payload for direct querying.
ORDER_FIELDS = {
    "order_id": "string",
    "customer_id": "string",
    "order_status": "string",
    "payment_status": "string",
    "total_amount": "double",
    "is_valid": "string",
    "data_quality_score": "double",
}
# Context defaults.
CONSUMER_GROUP = "default"
UNKNOWN = "unknown"


def ingestion_columns(at: Column) -> dict[str, Column]:
    return {
        "ingestion_timestamp": at,
        "ingestion_date": F.to_date(at),
        "ingestion_hour": F.hour(at),
    }


def record_id(style: str, sequence: Column | None = None) -> Column:
    """Row ids: `epoch` (partition-offset-seconds), `sequence` (po_partition_offset_seq), `uuid`."""
    where = (F.col("partition"), F.col("offset"))
    if style == "epoch":
        return F.concat_ws("-", *where, epoch_text(F.col("ingestion_timestamp")))
    if style == "sequence":
        return F.concat_ws("_", F.lit("po"), *where, sequence)
    if style == "uuid":
        return F.uuid()
    raise ValueError(f"unknown record id style: {style}")


def to_bronze(
    log: DataFrame,
    *,
    at: Column | None = None,
    id_style: str = "epoch",
    log_name: str = UNKNOWN,
    consumer_group: str = CONSUMER_GROUP,
    cluster_id: str = UNKNOWN,
) -> DataFrame:
    """Wrap log messages (key, value, partition, offset, timestamp) in the Bronze envelope.

    A map-only projection: it keeps the partitioning of the log, in batch and in a stream.
    """
    at = F.current_timestamp() if at is None else at
    sequence = F.unix_timestamp("timestamp") * 1000
    return log.withColumns(ingestion_columns(at)).select(
        record_id(id_style, sequence).alias("record_id"),
        "ingestion_timestamp",
        "ingestion_date",
        "ingestion_hour",
        F.col("partition").cast("string").alias("log_partition"),
        F.col("offset").cast("string").alias("log_offset"),
        sequence.alias("log_sequence"),
        F.col("timestamp").alias("log_enqueued_at"),
        F.col("key").cast("string").alias("log_partition_key"),
        F.lit(cluster_id).alias("processing_cluster_id"),
        F.lit(consumer_group).alias("consumer_group"),
        F.lit(log_name).alias("log_name"),
        F.coalesce(F.col("value").cast("string"), F.lit("")).alias("raw_payload"),
        F.coalesce(F.octet_length("value"), F.lit(0)).alias("payload_size_bytes"),
    )


def to_order_bronze(log: DataFrame, **options) -> DataFrame:
    """The Bronze envelope plus the business fields, read from the payload in one parse."""
    fields = ", ".join(f"{name} STRING" for name in ORDER_FIELDS)
    return (
        to_bronze(log, **options)
        .withColumn("payload_fields", F.from_json("raw_payload", fields))
        .select(
            "*",
            *(
                F.col(f"payload_fields.{name}").try_cast(kind).alias(name)
                for name, kind in ORDER_FIELDS.items()
            ),
        )
        .withColumns(
            {
                "log_partition": F.col("log_partition").cast("int"),
                "log_offset": F.col("log_offset").cast("bigint"),
            }
        )
        .drop("payload_fields", "log_partition_key")
    )


def invalid_flagged(bronze: DataFrame) -> DataFrame:
    """Rows whose producer marked them invalid; JSON booleans arrive as lower-case text."""
    return bronze.filter(F.lower("is_valid") == "false")


def add_date_partitions(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns(date_parts(F.col(column)))


def to_messages(
    df: DataFrame, key: str, properties: Sequence[str], *, normalise_key: bool = True
) -> DataFrame:
    """Rows as log messages: key, JSON value, and text properties as headers."""
    named = F.col(key).cast("string")
    return df.select(
        (partition_key(named) if normalise_key else named).alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
        F.create_map(
            *(part for name in properties for part in (F.lit(name), F.col(name).cast("string")))
        ).alias("headers"),
    )


def messages_with(messages: DataFrame, path: str, values: Sequence[str]) -> DataFrame:
    """Messages whose JSON value has one of `values` at `path`; without it or without JSON they go."""
    return messages.filter(F.get_json_object("value", path).isin(*values))


def kafka_headers(headers: Column) -> Column:
    """The headers column in the shape Spark's Kafka sink takes."""
    return F.transform(
        F.map_entries(headers),
        lambda entry: F.struct(entry["key"].alias("key"), entry["value"].cast("binary").alias("value")),
    )


# The event envelope.
EVENT_TYPE = "PurchaseOrderItemCreated"
EVENT_VERSION = "1.0"
EVENT_SOURCE = "purchase-order-pipeline"
CONTENT_TYPE = "application/json"


def to_event_envelope(
    df: DataFrame,
    *,
    at: Column | None = None,
    correlation: str = "order_id",
    event_id: Column | None = None,
) -> DataFrame:
    """Each row as a nested event: type, time, version, source, data and metadata, as JSON."""
    at = F.current_timestamp() if at is None else at
    event_id = F.unix_micros(F.current_timestamp()) if event_id is None else event_id
    envelope = F.struct(
        F.lit(EVENT_TYPE).alias("eventType"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("eventTime"),
        F.lit(EVENT_VERSION).alias("eventVersion"),
        F.lit(EVENT_SOURCE).alias("source"),
        F.struct("*").alias("data"),
        F.struct(
            F.lit(CONTENT_TYPE).alias("contentType"),
            F.coalesce(F.col(correlation), F.lit(UNKNOWN)).alias("correlationId"),
            F.concat(F.lit("event-"), event_id.cast("string")).alias("eventId"),
        ).alias("metadata"),
    )
    return df.select(F.to_json(envelope).alias("value"))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})
