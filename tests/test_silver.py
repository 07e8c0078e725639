"""Parsing, defaults, scalars and masks."""

import datetime

import pytest
from pyspark.sql import functions as F

from lakequality import schemas
from lakequality.functions import privacy, scalars
from lakequality.functions.casts import safe_cast
from lakequality.operators import bronze, silver

READING = (
    '{"event_id":"weather-event-123","city":"New York","latitude":40.7128,"longitude":-74.006,'
    '"temperature":22.5,"humidity":65.0,"wind_speed":8.2,"pressure":1013.25,"precipitation":0.0,'
    '"cloud_cover":25.0,"weather_condition":"partly_cloudy","timestamp":"2024-01-15T10:30:00Z",'
    '"data_source":"sensor_data","cluster_id":"cluster-123","notebook_path":"/test/weather"}'
)
INGESTED = datetime.datetime(2024, 1, 15, 11, 0, 0)


def log(spark, *payloads):
    data = [
        (b"key", None if text is None else bytearray(text, "utf-8"), 3, number, INGESTED)
        for number, text in enumerate(payloads)
    ]
    return spark.createDataFrame(data, schemas.LOG)


def bronze_rows(spark, *payloads):
    return bronze.to_bronze(log(spark, *payloads), at=F.col("timestamp"))


def test_bronze_envelope(spark):
    first, empty = bronze_rows(spark, '{"a":"São"}', None).collect()
    assert first["record_id"] == f"3-0-{int(INGESTED.replace(tzinfo=datetime.UTC).timestamp())}"
    assert (first["ingestion_date"], first["ingestion_hour"]) == (datetime.date(2024, 1, 15), 11)
    assert first["payload_size_bytes"] == 12 and len(first["raw_payload"]) == 11
    assert (empty["raw_payload"], empty["payload_size_bytes"]) == ("", 0)
    assert [field.name for field in bronze_rows(spark, "{}").schema] == schemas.names(schemas.BRONZE)


def test_bronze_ids(spark):
    rows = bronze.to_bronze(log(spark, "{}"), at=F.col("timestamp"), id_style="sequence")
    assert rows.first()["record_id"].startswith("po_3_0_17053")
    assert len(bronze.to_bronze(log(spark, "{}"), id_style="uuid").first()["record_id"]) == 36
    with pytest.raises(ValueError):
        bronze.to_bronze(log(spark, "{}"), id_style="other")


def test_order_bronze_fields_and_invalid_flag(spark):
    rows = bronze.to_order_bronze(
        log(
            spark,
            '{"order_id":"o1","total_amount":"12.5","is_valid":false}',
            '{"order_id":"o2","total_amount":"x","is_valid":true}',
            '{"order_id":"o3"',
        ),
        at=F.col("timestamp"),
    )
    assert [field.name for field in rows.schema] == schemas.names(schemas.BRONZE_ORDERS)
    found = {row["log_offset"]: row for row in rows.collect()}
    assert found[0]["total_amount"] == 12.5 and found[1]["total_amount"] is None
    assert found[2]["order_id"] is None
    assert [row["order_id"] for row in bronze.invalid_flagged(rows).collect()] == ["o1"]


def test_weather_parsing_states(spark):
    parsed = silver.parse_payload(
        bronze_rows(spark, READING, '{"city":"Oslo"}', "{broken", "", '{"x":1}', '{"temperature":"hot"}'),
        schemas.WEATHER_PAYLOAD,
    )
    found = parsed.orderBy("log_offset").collect()
    assert [row["parsing_status"] for row in found] == [
        "SUCCESS",
        "PARTIAL",
        "FAILED",
        "FAILED",
        "FAILED",
        "FAILED",
    ]
    assert found[0]["parsing_errors"] == []
    assert found[1]["parsing_errors"] == [scalars.PARSE_PARTIAL_TEXT]
    assert found[0]["weather_timestamp"] == datetime.datetime(2024, 1, 15, 10, 30)
    assert found[0]["latitude"] == 40.7128 and found[5]["temperature"] is None


def test_weather_defaults(spark):
    parsed = silver.parse_payload(bronze_rows(spark, '{"city":"Oslo"}', "{}"), schemas.WEATHER_PAYLOAD)
    epoch = int(INGESTED.replace(tzinfo=datetime.UTC).timestamp())
    first, second = silver.fill_weather(parsed).orderBy("log_offset").collect()
    assert first["event_id"] == f"Oslo-{epoch}" and second["event_id"] == f"unknown-{epoch}"
    assert first["weather_timestamp"] == INGESTED
    assert first["data_source"] == silver.WEATHER_SOURCE
    # Built from the message time alone, the id stays NULL when there is none.
    assert silver.fill_weather(parsed, id_before_time=True).first()["event_id"] is None


def test_weather_silver_schema(spark):
    rows = silver.weather_silver(bronze_rows(spark, READING), at=F.col("bronze_ingestion_timestamp"))
    assert rows.columns == schemas.names(schemas.SILVER_WEATHER) and len(rows.columns) == 33
    assert "raw_payload" not in rows.columns
    assert rows.first()["silver_processing_hour"] == 11


def test_schema_sizes(spark):
    assert len(schemas.names(schemas.SILVER_WEATHER_QUALITY)) == 42
    assert len(schemas.names(schemas.SILVER_ORDERS_QUALITY)) == 51
    assert len(schemas.names(schemas.ORDER_MESSAGE)) == 28
    assert len(schemas.WEATHER_PAYLOAD.fields) == 15 and len(schemas.ORDER_PAYLOAD.fields) == 24


def test_order_parsing_and_defaults(spark):
    parsed = silver.parse_payload(
        bronze_rows(
            spark,
            '{"order_id":"o1","product_id":"p","customer_id":"c","quantity":"5.0","unit_price":1.005}',
            '{"order_id":"o2","quantity":"many","total_amount":"1234567890.12"}',
            "[1]",
            "{}",
        ),
        schemas.ORDER_PAYLOAD,
    ).orderBy("log_offset")
    first, second, third, _ = parsed.collect()
    assert first["quantity"] == 5 and str(first["unit_price"]) == "1.01"
    assert first["parsing_status"] == "SUCCESS" and second["parsing_status"] == "PARTIAL"
    assert second["quantity"] is None and second["total_amount"] is None
    assert third["parsing_status"] == "FAILED"
    filled = silver.fill_orders(parsed).orderBy("log_offset").collect()
    assert (filled[1]["quantity"], filled[1]["order_status"], filled[1]["payment_status"]) == (0, "NEW", "PENDING")
    assert float(filled[1]["total_amount"]) == 0.0 and filled[1]["order_date"] == INGESTED
    ids = [row["order_id"] for row in filled]
    assert len(set(ids)) == 4
    same = silver.fill_orders(parsed, colliding_ids=True).orderBy("log_offset").collect()
    assert same[2]["order_id"] == same[3]["order_id"] and same[2]["order_id"].startswith("ORD-")


def test_dead_letters(spark):
    parsed = silver.parse_payload(bronze_rows(spark, READING, "{broken"), schemas.WEATHER_PAYLOAD)
    [row] = silver.dead_letters(parsed).collect()
    assert row["raw_payload"] == "{broken" and row["reason"] == scalars.PARSE_FAILED_TEXT


def test_business_rules_apply_in_order(spark):
    data = spark.createDataFrame([(2, 3.0), (0, 9.0)], "quantity INT, unit_price DOUBLE")
    rules = [
        {"type": "filter", "condition": "quantity > 0"},
        {"type": "transform", "column": "total", "formula": "quantity * unit_price"},
    ]
    assert [row["total"] for row in silver.apply_business_rules(data, rules).collect()] == [6.0]
    with pytest.raises(ValueError):
        silver.apply_business_rules(data, [{"type": "drop"}])


def test_safe_cast(spark):
    row = spark.range(1).select(
        safe_cast(F.lit("5.0"), "int").alias("a"),
        safe_cast(F.lit("x"), "double").alias("b"),
        safe_cast(F.lit("99999999999"), "int").alias("c"),
        safe_cast(F.lit("2024-02-30"), "timestamp").alias("d"),
    ).first()
    assert tuple(row) == (5, None, None, None)


@pytest.mark.parametrize(
    "mask, text, shown",
    [
        (privacy.mask_email, "alice@example.com", "al***@example.com"),
        (privacy.mask_email, "a@b@c", "a***@b@c"),
        (privacy.mask_email, "nobody", "***"),
        (privacy.mask_phone, "555-123-4567", "***-***-4567"),
        (privacy.mask_phone, "12", "***"),
        (privacy.mask_card, "4111 1111 1111 1234", "****-****-****-1234"),
        (privacy.mask_card, "12", "****"),
        (privacy.mask_email, None, None),
    ],
)
def test_masks(spark, mask, text, shown):
    data = spark.createDataFrame([(text,)], "t STRING")
    assert data.select(mask(F.col("t"))).first()[0] == shown


def test_mask_only_present_columns(spark):
    data = spark.createDataFrame([("bob@x.org", "k")], "email STRING, other STRING")
    assert tuple(privacy.mask_customer_data(data).first()) == ("bo***@x.org", "k")


def test_scalars(spark):
    days = [datetime.date(2024, month, 15) for month in (1, 4, 7, 10)]
    data = spark.createDataFrame([(day,) for day in days], "d DATE")
    quarters = [row[0] for row in data.select(scalars.fiscal_quarter(F.col("d"))).collect()]
    assert quarters == ["Q1-2024", "Q2-2024", "Q3-2024", "Q4-2024"]
    row = spark.range(1).select(
        scalars.sanitize(F.lit(' <b>"x"</b> ')),
        scalars.sanitize(F.lit("abcdef"), 3),
        scalars.partition_key(F.lit("New York")),
        scalars.left_pad(F.lit(1234567), 6),
        scalars.left_pad(F.lit(12), 6),
        scalars.net_amount(F.lit(2), F.lit(25.0), F.lit(5.0), F.lit(3.0), F.lit(0.0)),
    ).first()
    assert tuple(row) == ("bx/b", "abc", "newyork", "1234567", "000012", 48.0)
    tiers = spark.createDataFrame([(n,) for n in (10, 11, 21, 51)], "n INT")
    assert [r[0] for r in tiers.select(scalars.discount_rate(F.col("n"))).collect()] == [0.0, 0.035, 0.075, 0.125]
    amounts = spark.createDataFrame([(n,) for n in (1000, 1001, 5001)], "n INT")
    assert [r[0] for r in amounts.select(scalars.priority(F.col("n"))).collect()] == ["LOW", "NORMAL", "HIGH"]


def test_messages_and_envelope(spark):
    data = spark.createDataFrame([("New York", 1, None)], "city STRING, n INT, note STRING")
    row = bronze.to_messages(data, "city", ["n"]).first()
    assert (row["key"], row["headers"]) == ("newyork", {"n": "1"})
    assert row["value"] == '{"city":"New York","n":1,"note":null}'
    event = bronze.to_event_envelope(data.withColumn("order_id", F.lit(None).cast("string"))).first()[0]
    assert '"correlationId":"unknown"' in event and '"eventType":"PurchaseOrderItemCreated"' in event


def test_order_message_round_trip(spark):
    message = schemas.struct(schemas.ORDER_MESSAGE)
    values = {field.name: None for field in message} | {"order_id": "o", "quantity": 2, "is_valid": True}
    data = spark.createDataFrame([tuple(values.values())], message)
    text = data.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j"))
    back = text.select(F.from_json("j", message).alias("r")).select("r.*")
    assert back.collect() == data.collect()


def test_existing_names(spark):
    renamed = bronze.rename(bronze_rows(spark, "{}"), schemas.EXISTING_NAMES)
    assert {"stream_partition", "stream_offset", "stream_name"} <= set(renamed.columns)


def test_enrich_keeps_unmatched_rows(spark):
    left = spark.createDataFrame([(1,), (2,)], "k INT")
    master = spark.createDataFrame([(1, "one")], "k INT, name STRING")
    assert {tuple(r) for r in silver.enrich(left, master, ["k"]).collect()} == {(1, "one"), (2, None)}


def test_json_rows_paths_flags_and_recent_times(spark):
    at = datetime.datetime(2024, 1, 31, 10, 30)
    rows = spark.createDataFrame(
        [(1, "new", at), (2, None, at - datetime.timedelta(hours=1)), (3, "old", at - datetime.timedelta(hours=11))],
        "id int, status string, time timestamp",
    )
    text = silver.to_json_rows(rows)
    assert '"status":null' in text.filter("json LIKE '%\"id\":2%'").first().json
    back = silver.from_json_rows(text, rows.schema).orderBy("id").collect()
    assert [(r.id, r.status, r.time) for r in back] == [(r.id, r.status, r.time) for r in rows.collect()]
    paths = silver.json_paths(text, {"a": "$.id", "none": "$.other"}).orderBy("a").collect()
    assert [(r.a, r.none) for r in paths] == [("1", None), ("2", None), ("3", None)]
    assert silver.from_json_rows(spark.createDataFrame([("{",)], "json string"), rows.schema).first().id is None
    flags = silver.with_flags(rows, {"is_new": "status = 'new'"}).orderBy("id").collect()
    assert [r.is_new for r in flags] == [True, None, False]
    messages = bronze.to_messages(rows, "id", ["status"])
    assert [r.key for r in bronze.messages_with(messages, "$.status", ["new", "late"]).collect()] == ["1"]
    now = F.lit(at)
    near = rows.select(
        "id", scalars.on_day(F.col("time"), now).alias("d"), scalars.within_hours(F.col("time"), now).alias("h")
    )
    assert [(r.d, r.h) for r in near.orderBy("id").collect()] == [(True, True), (True, True), (False, False)]
