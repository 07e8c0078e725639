"""From Bronze rows to typed Silver rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakequality import schemas
from lakequality.functions import scalars
from lakequality.functions.casts import safe_cast

# Defaults for fields a message may lack.
WEATHER_SOURCE = "sensor_simulator"
ORDER_DEFAULTS = {"order_status": "NEW", "payment_status": "PENDING"}
ORDER_NUMBERS = {
    "quantity": 0,
    "unit_price": 0.0,
    "total_amount": 0.0,
    "discount_percentage": 0.0,
    "tax_amount": 0.0,
}

# Bronze columns that Silver carries on under another name.
INHERITED_AS = {
    "record_id": "source_record_id",
    "ingestion_timestamp": "bronze_ingestion_timestamp",
    "ingestion_date": "bronze_ingestion_date",
    "ingestion_hour": "bronze_ingestion_hour",
    "payload_size_bytes": "original_payload_size_bytes",
}


def parse_payload(bronze: DataFrame, payload: schemas.Payload) -> DataFrame:
    """Typed payload columns beside the inherited Bronze columns, with parsing status and errors.

    The text is parsed once, as strings; the casts then give NULL per field instead of losing the
    row. Only the fields that later steps use are read from the JSON.
    """
    text_schema = ", ".join(f"`{field.json}` STRING" for field in payload.fields)
    inherited = [
        F.col(name).alias(INHERITED_AS.get(name, name))
        for name in bronze.columns
        if name not in {field.name for field in payload.fields}
    ]
    typed = [
        safe_cast(F.col(f"payload_text.`{field.json}`"), field.type).alias(field.name)
        for field in payload.fields
    ]
    status = scalars.parsing_status(payload.required, payload.any_of)
    return (
        bronze.withColumn("payload_text", F.from_json("raw_payload", text_schema))
        .select(*inherited, *typed)
        .withColumn("parsing_status", status)
        .withColumn("parsing_errors", scalars.parsing_errors(F.col("parsing_status")))
    )


def fill_weather(parsed: DataFrame, *, id_before_time: bool = False) -> DataFrame:
    """Ids, times and source for weather rows that lack them.

    `id_before_time` builds the id from the time in the message alone, so it stays NULL when both
    are missing.
    """
    message_time = F.col("weather_timestamp")
    filled_time = F.coalesce(message_time, F.col("bronze_ingestion_timestamp"))
    id_time = message_time if id_before_time else filled_time
    return parsed.withColumns(
        {
            "event_id": scalars.surrogate_event_id(F.col("event_id"), F.col("city"), id_time),
            "weather_timestamp": filled_time,
            "data_source": F.coalesce("data_source", F.lit(WEATHER_SOURCE)),
        }
    )


def fill_orders(parsed: DataFrame, *, colliding_ids: bool = False) -> DataFrame:
    """Ids, dates, statuses and numbers for order rows that lack them.

    `colliding_ids` leaves out the record digest, so ids generated in one second are equal.
    """
    source = None if colliding_ids else F.col("source_record_id")
    ingested = F.col("bronze_ingestion_timestamp")
    return parsed.withColumns(
        {
            "order_id": scalars.surrogate_order_id(F.col("order_id"), ingested, source),
            "order_date": F.coalesce("order_date", ingested),
            **{
                name: F.coalesce(name, F.lit(default)) for name, default in ORDER_DEFAULTS.items()
            },
        }
    ).fillna(ORDER_NUMBERS)


def silver_metadata(at: Column | None = None) -> dict[str, Column]:
    at = F.current_timestamp() if at is None else at
    return {
        "silver_processing_timestamp": at,
        "silver_processing_date": F.to_date(at),
        "silver_processing_hour": F.hour(at),
    }


def add_silver_metadata(df: DataFrame, at: Column | None = None) -> DataFrame:
    return df.withColumns(silver_metadata(at))


def add_stage_metadata(
    df: DataFrame, stage: str, job_id: str | None = None, at: Column | None = None
) -> DataFrame:
    """Which stage (and job) touched the row, and when."""
    tags = {
        "processing_timestamp": F.current_timestamp() if at is None else at,
        "processing_stage": F.lit(stage),
    }
    if job_id is not None:
        tags["job_id"] = F.lit(job_id)
    return df.withColumns(tags)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the columns of a table, in its order; the raw payload stays behind."""
    return df.select(*schemas.names(ddl))


def weather_silver(bronze: DataFrame, *, at: Column | None = None) -> DataFrame:
    parsed = fill_weather(parse_payload(bronze, schemas.WEATHER_PAYLOAD))
    return conform(add_silver_metadata(parsed, at), schemas.SILVER_WEATHER)


def apply_business_rules(df: DataFrame, rules: Sequence[Mapping[str, str]]) -> DataFrame:
    """Apply `{type: filter, condition}` and `{type: transform, column, formula}` in order."""
    for rule in rules:
        if rule["type"] == "filter":
            df = df.filter(F.expr(rule["condition"]))
        elif rule["type"] == "transform":
            df = df.withColumn(rule["column"], F.expr(rule["formula"]))
        else:
            raise ValueError(f"unknown business rule type: {rule['type']}")
    return df


def to_json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON text; null fields are written, timestamps in ISO form without a zone."""
    stamped = [
        F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd'T'HH:mm:ss").alias(f.name)
        if f.dataType.typeName().startswith("timestamp")
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*stamped).select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name)
    )


def from_json_rows(df: DataFrame, schema: StructType | str, column: str = "json") -> DataFrame:
    """The rows that `column` holds as JSON; text that can't be read gives a row of nulls."""
    return df.select(F.from_json(column, schema).alias("row")).select("row.*")


def json_paths(df: DataFrame, paths: Mapping[str, str], column: str = "json") -> DataFrame:
    """Add a text column for each name, read at its path; what is not there is null."""
    return df.withColumns({name: F.get_json_object(column, path) for name, path in paths.items()})


def with_flags(df: DataFrame, flags: Mapping[str, Column | str]) -> DataFrame:
    """Add a boolean column for each name; an unknown condition stays null."""
    return df.withColumns(
        {name: F.expr(flag) if isinstance(flag, str) else flag for name, flag in flags.items()}
    )


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Rows whose payload could not be read at all, with the text that failed."""
    return parsed.filter(F.col("parsing_status") == scalars.PARSE_FAILED).select(
        "source_record_id",
        "raw_payload",
        F.array_join("parsing_errors", "; ").alias("reason"),
    )


def enrich(df: DataFrame, master: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join with master data.

    No broadcast hint: Catalyst broadcasts the master only while its size is below
    `spark.sql.autoBroadcastJoinThreshold`; beyond it the sort-merge join splits skewed keys.
    """
    return df.join(master, list(keys), "left")
