"""Bronze: envelope, ids, ingestion columns, scans, writes, messages."""

from pyspark.sql import functions as F

from lakequality.functions import scalars
from lakequality.operators import bronze, dataset, loads, silver, sinks
from lakequality.plans import sql
from lakequality.plans.registry import query, stored
from lakequality.session import work_dir
from lakequality.sources import files, samples


@query(
    "bronze_from_log",
    f"""
WITH {sql.BRONZE}
SELECT record_id, ingestion_timestamp, ingestion_date, ingestion_hour, log_partition, log_offset,
       log_sequence, log_enqueued_at, log_partition_key, 'unknown' AS processing_cluster_id,
       'default' AS consumer_group, 'weather-events' AS log_name, raw_payload, payload_size_bytes
FROM bronze
""",
)
def bronze_from_log(spark, sf_dir):
    return samples.bronze_events(spark, sf_dir)


@query(
    "bronze_with_fields",
    f"""
WITH {sql.ORDER_ITEMS},
sent AS (SELECT *, l_orderkey % 37 = 0 AS broken FROM order_items)
SELECT CAST(l_suppkey % 4 AS INTEGER) AS log_partition,
       l_orderkey * 10 + line_number AS log_offset,
       'po_' || (l_suppkey % 4) || '_' || (l_orderkey * 10 + line_number) || '_' ||
         CAST(epoch(ship_date) AS BIGINT) * 1000 AS record_id,
       CASE WHEN NOT broken THEN order_id END AS order_id,
       CASE WHEN NOT broken THEN customer_id END AS customer_id,
       CASE WHEN NOT broken AND l_orderkey % 47 <> 0 THEN order_status END AS order_status,
       CASE WHEN NOT broken THEN payment_status END AS payment_status,
       CASE WHEN NOT broken AND l_orderkey % 43 <> 0 THEN CAST(total_amount AS DOUBLE) END
         AS total_amount,
       CASE WHEN NOT broken THEN CASE WHEN defect = 0 THEN 'true' ELSE 'false' END END AS is_valid,
       CASE WHEN NOT broken THEN CASE WHEN defect = 0 THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END END
         AS data_quality_score
FROM sent
""",
)
def bronze_with_fields(spark, sf_dir):
    log = samples.order_log(spark, sf_dir)
    rows = bronze.to_order_bronze(log, at=F.col("timestamp"), id_style="sequence")
    return rows.select("log_partition", "log_offset", "record_id", *bronze.ORDER_FIELDS)


@query(
    "invalid_flag_rows",
    f"""
WITH {sql.ORDER_ITEMS}
SELECT order_id, customer_id, 'false' AS is_valid
FROM order_items WHERE defect = 1 AND l_orderkey % 37 <> 0
""",
)
def invalid_flag_rows(spark, sf_dir):
    log = samples.order_log(spark, sf_dir)
    rows = bronze.to_order_bronze(log, at=F.col("timestamp"))
    return bronze.invalid_flagged(rows).select("order_id", "customer_id", "is_valid")


@query(
    "record_ids",
    """
SELECT event_id AS log_offset,
       (user_id % 4) || '-' || event_id || '-' || CAST(floor(epoch(ts)) AS BIGINT) AS epoch_id,
       'po_' || (user_id % 4) || '_' || event_id || '_' ||
         CAST(floor(epoch(ts)) AS BIGINT) * 1000 AS sequence_id,
       36 AS uuid_length
FROM events
""",
)
def record_ids(spark, sf_dir):
    log = samples.event_log(spark, sf_dir)
    rows = log.withColumns(bronze.ingestion_columns(F.col("timestamp")))
    sequence = F.unix_timestamp("timestamp") * 1000
    return rows.select(
        F.col("offset").alias("log_offset"),
        bronze.record_id("epoch").alias("epoch_id"),
        bronze.record_id("sequence", sequence).alias("sequence_id"),
        F.length(bronze.record_id("uuid")).alias("uuid_length"),
    )


@query(
    "ingestion_columns",
    """
SELECT event_id, ts AS ingestion_timestamp, CAST(ts AS DATE) AS ingestion_date,
       CAST(hour(ts) AS INTEGER) AS ingestion_hour
FROM events
""",
)
def ingestion_columns(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "events")
    moment = F.col("ts").cast("timestamp")
    return rows.withColumns(bronze.ingestion_columns(moment)).select(
        "event_id", "ingestion_timestamp", "ingestion_date", "ingestion_hour"
    )


@query(
    "payload_size",
    """
SELECT conv_id, turn, CAST(strlen(text) AS INTEGER) AS payload_size_bytes,
       CAST(length(text) AS INTEGER) AS payload_chars
FROM conversations
""",
)
def payload_size(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "conversations")
    return rows.select(
        "conv_id",
        "turn",
        F.octet_length(F.encode("text", "UTF-8")).alias("payload_size_bytes"),
        F.length("text").alias("payload_chars"),
    )


@query(
    "partition_columns",
    """
SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour
FROM events
""",
)
def partition_columns(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "events")
    return bronze.add_date_partitions(rows, "ts").select("event_id", "year", "month", "day", "hour")


@query(
    "message_rows",
    """
SELECT replace(lower(c_name), ' ', '') AS key, c_custkey, c_name, c_nationkey, c_acctbal,
       c_mktsegment, c_mktsegment AS segment_property, CAST(c_nationkey AS VARCHAR) AS nation_property
FROM customer
""",
)
def message_rows(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "customer")
    messages = bronze.to_messages(rows, "c_name", ["c_mktsegment", "c_nationkey"])
    read = F.from_json("value", rows.schema)
    return messages.withColumn("read", read).select(
        "key",
        "read.*",
        F.col("headers")["c_mktsegment"].alias("segment_property"),
        F.col("headers")["c_nationkey"].alias("nation_property"),
    )


@query(
    "message_filter",
    """
SELECT event_id, event_type, value FROM events WHERE event_type IN ('purchase', 'signup')
""",
)
def message_filter(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "events")
    rows = rows.select("event_id", "event_type", "value")
    wanted = bronze.messages_with(bronze.to_messages(rows, "event_id", ["event_type"]), "$.event_type", ["purchase", "signup"])
    return silver.from_json_rows(wanted, rows.schema, "value")


@query(
    "event_envelope",
    f"""
WITH {sql.ORDER_ITEMS}
SELECT 'PurchaseOrderItemCreated' AS event_type, strftime(ship_date, '%Y-%m-%dT%H:%M:%S') AS event_time,
       '1.0' AS version, 'purchase-order-pipeline' AS source, order_id AS data_order_id,
       CAST(quantity AS VARCHAR) AS data_quantity, 'application/json' AS content_type,
       order_id AS correlation_id, 'event-' || (l_orderkey * 10 + line_number) AS event_id
FROM order_items
""",
)
def event_envelope(spark, sf_dir):
    rows = samples.order_items(spark, sf_dir).select(
        "order_id", "quantity", "ship_date", "l_orderkey", "line_number"
    )
    number = F.col("l_orderkey") * 10 + F.col("line_number")
    events = bronze.to_event_envelope(rows, at=F.col("ship_date"), event_id=number)
    read = F.from_json(
        "value",
        "eventType STRING, eventTime STRING, eventVersion STRING, source STRING, "
        "data STRUCT<order_id: STRING, quantity: STRING>, "
        "metadata STRUCT<contentType: STRING, correlationId: STRING, eventId: STRING>",
    )
    return events.select(read.alias("e")).select(
        F.col("e.eventType").alias("event_type"),
        F.col("e.eventTime").alias("event_time"),
        F.col("e.eventVersion").alias("version"),
        F.col("e.source").alias("source"),
        F.col("e.data.order_id").alias("data_order_id"),
        F.col("e.data.quantity").alias("data_quantity"),
        F.col("e.metadata.contentType").alias("content_type"),
        F.col("e.metadata.correlationId").alias("correlation_id"),
        F.col("e.metadata.eventId").alias("event_id"),
    )


def written_bronze(spark, sf_dir):
    """Bronze events as a table by date and hour.

    Ranges over date, hour and id give few files per folder, and cut a hot hour into ranges.
    """

    def build():
        rows = samples.bronze_events(spark, sf_dir)
        return rows.repartitionByRange("ingestion_date", "ingestion_hour", "record_id")

    return stored(spark, sf_dir, "bronze", build, ["ingestion_date", "ingestion_hour"])


@query(
    "bronze_scan_range",
    f"""
WITH {sql.BRONZE}
SELECT ingestion_date, ingestion_hour, record_id, payload_size_bytes
FROM bronze
WHERE ingestion_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND ingestion_hour IN (0, 6, 12, 18)
""",
)
def bronze_scan_range(spark, sf_dir):
    rows = files.bronze_range(
        written_bronze(spark, sf_dir), "2024-01-05", "2024-01-20", [0, 6, 12, 18]
    )
    return rows.select("ingestion_date", "ingestion_hour", "record_id", "payload_size_bytes")


@query(
    "bronze_write_report",
    f"""
WITH {sql.BRONZE}
SELECT ingestion_date, ingestion_hour, count(*) AS n
FROM bronze GROUP BY ingestion_date, ingestion_hour
""",
)
def bronze_write_report(spark, sf_dir):
    return sinks.write_report(written_bronze(spark, sf_dir), ["ingestion_date", "ingestion_hour"])


@query(
    "bronze_sample",
    f"""
WITH {sql.BRONZE}
SELECT record_id, payload_size_bytes FROM bronze
WHERE CAST('0x' || left(md5(record_id), 13) AS BIGINT)::DOUBLE
      < 1000::DOUBLE / (SELECT count(*) FROM bronze) * 4503599627370496::DOUBLE
""",
)
def bronze_sample(spark, sf_dir):
    return dataset.sample_rows(samples.bronze_events(spark, sf_dir), 1000, "record_id").select(
        "record_id", "payload_size_bytes"
    )


@query(
    "silver_metadata",
    """
SELECT event_id, ts AS silver_processing_timestamp, CAST(ts AS DATE) AS silver_processing_date,
       CAST(hour(ts) AS INTEGER) AS silver_processing_hour
FROM events
""",
)
def silver_metadata(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "events")
    return silver.add_silver_metadata(rows, F.col("ts").cast("timestamp")).select(
        "event_id",
        "silver_processing_timestamp",
        "silver_processing_date",
        "silver_processing_hour",
    )


@query(
    "stage_metadata",
    """
SELECT event_id, TIMESTAMP '2024-01-31 00:00:00' AS processing_timestamp,
       'silver' AS processing_stage, 'job-7' AS job_id
FROM events
""",
)
def stage_metadata(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "events").select("event_id")
    return silver.add_stage_metadata(rows, "silver", "job-7", samples.at(samples.EVENTS_AS_OF))


@query(
    "recent_rows",
    """
SELECT event_id,
       CAST(ts >= TIMESTAMP '2024-01-30 00:00:00' AS INTEGER) AS today,
       CAST(ts >= TIMESTAMP '2024-01-30 23:00:00' AS INTEGER) AS last_hour
FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00'
""",
)
def recent_rows(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    as_of = samples.at(samples.EVENTS_AS_OF)
    last = as_of - F.expr("INTERVAL 1 MICROSECOND")  # of the day that ends at `as_of`
    return rows.filter(scalars.on_day(F.col("ts"), last)).select(
        "event_id",
        F.lit(1).alias("today"),
        scalars.within_hours(F.col("ts"), as_of).cast("int").alias("last_hour"),
    )


@query(
    "payload_checks",
    """
SELECT page_id, CAST(html IS NULL OR html = '' AS INTEGER) AS blank,
       CAST(strlen(html) AS INTEGER) AS size FROM pages
""",
)
def payload_checks(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "pages")
    return rows.select(
        "page_id",
        dataset.is_blank("html").cast("int").alias("blank"),
        F.octet_length("html").alias("size"),
    )


@query(
    "surrogate_order_id",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_orderkey % 5 = 0 THEN 'ORD-' || CAST(epoch(l_shipdate) AS BIGINT)
            ELSE CAST(l_orderkey AS VARCHAR) END AS plain_id,
       CASE WHEN l_orderkey % 5 = 0
            THEN 'ORD-' || CAST(epoch(l_shipdate) AS BIGINT) || '-' || left(sha256(
                   l_orderkey || '-' || l_linenumber), 12)
            ELSE CAST(l_orderkey AS VARCHAR) END AS unique_id
FROM lineitem
""",
)
def surrogate_order_id(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "lineitem")
    sent = F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey").cast("string"))
    moment = F.col("l_shipdate").cast("timestamp")
    source = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        scalars.surrogate_order_id(sent, moment).alias("plain_id"),
        scalars.surrogate_order_id(sent, moment, source).alias("unique_id"),
    )


@query(
    "bronze_write_manifest",
    f"""
WITH {sql.BRONZE},
parts AS (SELECT *, CASE WHEN CAST(log_offset AS BIGINT) % 3 = 0 THEN 'first' ELSE 'second' END AS load_id FROM bronze)
SELECT load_id, ingestion_date, count(*) AS n, sum(count(*)) OVER (PARTITION BY ingestion_date)::BIGINT AS in_table,
       true AS files_in_place
FROM parts GROUP BY load_id, ingestion_date
""",
)
def bronze_write_manifest(spark, sf_dir):
    """Two appends to the same folders, the first delivered twice; each reports its own rows."""
    rows = samples.bronze_events(spark, sf_dir).select("record_id", "log_offset", "payload_size_bytes", "ingestion_date")
    rows = rows.repartitionByRange("ingestion_date")
    first = F.col("log_offset").cast("bigint") % 3 == 0
    path = work_dir(spark, "loads")
    for load_id, part in (("first", first), ("second", ~first), ("first", first)):
        loads.write_load(rows.filter(part), path, load_id, ["ingestion_date"])
    both = loads.manifest(spark, path, "first").unionByName(loads.manifest(spark, path, "second"))
    table = spark.read.parquet(path)
    held = table.groupBy("ingestion_date").agg(
        F.count(F.lit(1)).alias("in_table"), F.count_distinct("_metadata.file_path").alias("held_files")
    )
    told = both.groupBy("ingestion_date").agg(F.sum("files").alias("told_files"))
    return (
        both.join(held, "ingestion_date", "left")
        .join(told, "ingestion_date")
        .select("load_id", "ingestion_date", "n", "in_table", (F.col("told_files") == F.col("held_files")).alias("files_in_place"))
    )
