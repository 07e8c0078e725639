"""Table and payload schemas as DDL text, the form both readers and CREATE TABLE accept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def names(ddl: str) -> list[str]:
    return struct(ddl).names


# Columns a message log hands over (the shape of Spark's Kafka source).
LOG = "key BINARY, value BINARY, partition INT, offset BIGINT, timestamp TIMESTAMP"

# ---- Bronze ---------------------------------------------------------------------------------

INGESTION = (
    "record_id STRING NOT NULL, ingestion_timestamp TIMESTAMP NOT NULL, "
    "ingestion_date DATE NOT NULL, ingestion_hour INT NOT NULL"
)
LOG_POSITION = (
    "log_partition STRING, log_offset STRING, log_sequence BIGINT, log_enqueued_at TIMESTAMP"
)
CONTEXT = "processing_cluster_id STRING, consumer_group STRING, log_name STRING"

BRONZE = (
    f"{INGESTION}, {LOG_POSITION}, log_partition_key STRING, {CONTEXT}, "
    "raw_payload STRING, payload_size_bytes INT"
)
BRONZE_ORDERS = (
    f"{INGESTION}, log_partition INT, log_offset BIGINT, log_sequence BIGINT, "
    f"log_enqueued_at TIMESTAMP, {CONTEXT}, raw_payload STRING NOT NULL, payload_size_bytes INT, "
    "order_id STRING, customer_id STRING, order_status STRING, payment_status STRING, "
    "total_amount DOUBLE, is_valid STRING, data_quality_score DOUBLE"
)
BRONZE_PARTITIONS = ["ingestion_date", "ingestion_hour"]

# ---- Silver ---------------------------------------------------------------------------------

INHERITED = (
    "source_record_id STRING NOT NULL, bronze_ingestion_timestamp TIMESTAMP NOT NULL, "
    "bronze_ingestion_date DATE NOT NULL, bronze_ingestion_hour INT NOT NULL, "
    f"{LOG_POSITION}, log_partition_key STRING, {CONTEXT}"
)
PROCESSING = (
    "silver_processing_timestamp TIMESTAMP NOT NULL, silver_processing_date DATE NOT NULL, "
    "silver_processing_hour INT NOT NULL"
)
PARSING = (
    "original_payload_size_bytes INT, parsing_status STRING NOT NULL, parsing_errors ARRAY<STRING>"
)
QUALITY = (
    "quality_flag STRING NOT NULL, failure_reason STRING, rule_results ARRAY<STRING>, "
    "quality_score DOUBLE NOT NULL, validated_at TIMESTAMP NOT NULL, lineage_id STRING, "
    "criticality STRING, failed_rules INT NOT NULL, passed_rules INT NOT NULL"
)
SILVER_PARTITIONS = ["silver_processing_date", "silver_processing_hour"]

WEATHER = (
    "event_id STRING NOT NULL, city STRING, latitude DOUBLE, longitude DOUBLE, temperature DOUBLE, "
    "humidity DOUBLE, wind_speed DOUBLE, pressure DOUBLE, precipitation DOUBLE, "
    "cloud_cover DOUBLE, weather_condition STRING, weather_timestamp TIMESTAMP, "
    "data_source STRING, weather_cluster_id STRING, notebook_path STRING"
)
ORDERS = (
    "order_id STRING NOT NULL, product_id STRING, customer_id STRING, product_name STRING, "
    "quantity INT, unit_price DECIMAL(10,2), total_amount DECIMAL(10,2), "
    "discount_percentage DECIMAL(5,2), tax_amount DECIMAL(10,2), order_status STRING, "
    "payment_status STRING, order_date TIMESTAMP, ship_date TIMESTAMP, delivery_date TIMESTAMP, "
    "customer_email STRING, shipping_address STRING, billing_address STRING, "
    "product_category STRING, warehouse_id STRING, shipping_method STRING, "
    "tracking_number STRING, notes STRING, purchase_cluster_id STRING, notebook_path STRING"
)

SILVER_WEATHER = f"{WEATHER}, {INHERITED}, {PROCESSING}, {PARSING}"
SILVER_WEATHER_QUALITY = f"{SILVER_WEATHER}, {QUALITY}"
SILVER_ORDERS_QUALITY = f"{ORDERS}, {INHERITED}, {PROCESSING}, {PARSING}, {QUALITY}"


# ---- Payloads -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """One JSON field: where it sits, the type it should have, the column it becomes."""

    json: str
    type: str = "string"
    column: str | None = None

    @property
    def name(self) -> str:
        return self.column or self.json


@dataclass(frozen=True)
class Payload:
    """A JSON payload: its fields, and the columns that decide the parsing status."""

    fields: tuple[Field, ...]
    required: tuple[str, ...]
    any_of: tuple[str, ...]


_MONEY = "decimal(10,2)"

WEATHER_PAYLOAD = Payload(
    fields=(
        Field("event_id"),
        Field("city"),
        *(
            Field(measure, "double")
            for measure in (
                "latitude",
                "longitude",
                "temperature",
                "humidity",
                "wind_speed",
                "pressure",
                "precipitation",
                "cloud_cover",
            )
        ),
        Field("weather_condition"),
        Field("timestamp", "timestamp", "weather_timestamp"),
        Field("data_source"),
        Field("cluster_id", column="weather_cluster_id"),
        Field("notebook_path"),
    ),
    required=("event_id", "city", "temperature"),
    any_of=("event_id", "city", "temperature"),
)

ORDER_PAYLOAD = Payload(
    fields=(
        Field("order_id"),
        Field("product_id"),
        Field("customer_id"),
        Field("product_name"),
        Field("quantity", "int"),
        Field("unit_price", _MONEY),
        Field("total_amount", _MONEY),
        Field("discount_percentage", "decimal(5,2)"),
        Field("tax_amount", _MONEY),
        Field("order_status"),
        Field("payment_status"),
        Field("order_date", "timestamp"),
        Field("ship_date", "timestamp"),
        Field("delivery_date", "timestamp"),
        Field("customer_email"),
        Field("shipping_address"),
        Field("billing_address"),
        Field("product_category"),
        Field("warehouse_id"),
        Field("shipping_method"),
        Field("tracking_number"),
        Field("notes"),
        Field("cluster_id", column="purchase_cluster_id"),
        Field("notebook_path"),
    ),
    required=("order_id", "product_id", "customer_id", "quantity", "unit_price"),
    any_of=("order_id", "product_id", "customer_id"),
)

# The full purchase-order message (28 fields) as producers write it.
ORDER_MESSAGE = (
    "order_id STRING, product_id STRING, product_name STRING, quantity INT, unit_price DOUBLE, "
    "total_amount DOUBLE, customer_id STRING, vendor_id STRING, warehouse_location STRING, "
    "currency STRING, order_status STRING, payment_status STRING, timestamp STRING, "
    "created_at STRING, order_date STRING, fiscal_quarter STRING, shipping_method STRING, "
    "priority_level STRING, discount_amount DOUBLE, tax_amount DOUBLE, shipping_cost DOUBLE, "
    "is_valid BOOLEAN, validation_errors STRING, data_quality_score DOUBLE, source_system STRING, "
    "processing_timestamp STRING, cluster_id STRING, notebook_path STRING"
)

# ---- Names used by existing dashboards --------------------------------------------------------

# The column names that tables written by earlier jobs carry.
EXISTING_NAMES = {
    "log_partition": "stream_partition",
    "log_offset": "stream_offset",
    "log_sequence": "stream_sequence_number",
    "log_enqueued_at": "stream_enqueued_time",
    "log_partition_key": "stream_partition_key",
    "log_name": "stream_name",
    "quality_flag": "flag_check",
    "failure_reason": "description_failure",
    "rule_results": "check_rule_results",
    "quality_score": "check_quality_score",
    "validated_at": "check_validation_timestamp",
    "lineage_id": "check_lineage_id",
    "criticality": "check_criticality_level",
    "failed_rules": "failed_rules_count",
    "passed_rules": "passed_rules_count",
}
