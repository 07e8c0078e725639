"""The given tables in the shapes the operators take.

Messages and order rows are derived from every row of `events` and of `lineitem` with `orders` and
`part`. Fixed divisors of the keys decide which rows carry a defect; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequality.functions.scalars import left_pad, net_amount
from lakequality.operators import bronze as bronze_ops
from lakequality.session import JOIN_SETTINGS, prepare

EVENTS_AS_OF = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-08-01 00:00:00"
MONEY = "decimal(10,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark, **JOIN_SETTINGS).read.parquet(f"{sf_dir}/{name}.parquet")


def at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp")


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def _sent_text(broken: Column) -> Column:
    """The bytes of the JSON in `sent`, cut in half where `broken`."""
    half = F.substr(F.col("sent"), F.lit(1), F.floor(F.length("sent") / 2).cast("int"))
    # Texts are UTF-8 already; `encode` would check and copy each of them again.
    return F.when(broken, half).otherwise(F.col("sent")).cast("binary")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as log messages that carry weather readings.

    Every 17th message is cut in half; others lack the id, city or time, or have a negative
    temperature.
    """
    rows = table(spark, sf_dir, "events")
    time_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    reading = F.to_json(
        F.struct(
            F.when(~_every("event_id", 29), F.concat(F.lit("evt-"), "event_id")).alias("event_id"),
            F.when(~_every("event_id", 13), F.col("event_type")).alias("city"),
            (F.col("user_id") % 200 - 100).alias("latitude"),
            (F.col("user_id") * 3 % 400 - 200).alias("longitude"),
            F.when(_every("event_id", 11), -F.col("value"))
            .otherwise(F.col("value"))
            .alias("temperature"),
            (F.col("user_id") % 111).alias("humidity"),
            (F.col("event_id") % 40).alias("wind_speed"),
            (F.col("user_id") % 100 + 950).alias("pressure"),
            F.lit(0).alias("precipitation"),
            (F.col("event_id") % 101).alias("cloud_cover"),
            F.col("event_type").alias("weather_condition"),
            F.when(~_every("event_id", 19), time_text).alias("timestamp"),
            F.when(_every("event_id", 4), "external_api")
            .when(F.col("event_id") % 4 == 1, "sensor_data")
            .when(F.col("event_id") % 4 == 3, "other_feed")
            .alias("data_source"),
            F.concat(F.lit("cluster-"), F.col("user_id") % 4).alias("cluster_id"),
            F.lit("/jobs/weather").alias("notebook_path"),
        )
    )
    return rows.withColumn("sent", reading).select(
        F.encode("event_type", "UTF-8").alias("key"),
        _sent_text(_every("event_id", 17)).alias("value"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of `event_log`, taken in when they were sent."""
    log = event_log(spark, sf_dir)
    return bronze_ops.to_bronze(log, at=F.col("timestamp"), log_name="weather-events")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` with `orders` and `part` as purchase-order items.

    Every 23rd order has a wrong total, every 31st an empty customer; some mail addresses,
    shipping addresses and currencies break their rules.
    """
    lines = table(spark, sf_dir, "lineitem")
    # What an order or a part alone decides is worked out before the joins, once and not per item.
    orders = table(spark, sf_dir, "orders").withColumn(
        "order_date", F.col("o_orderdate").cast("timestamp")
    )
    parts = table(spark, sf_dir, "part").withColumn(
        "unit_price", F.col("p_retailprice").cast(MONEY)
    )
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        parts, lines.l_partkey == parts.p_partkey
    )
    defect = F.when(_every("l_orderkey", 23), F.lit(1)).otherwise(F.lit(0))
    supplier = F.col("l_suppkey")
    return (
        joined.select(
            F.concat(F.lit("ORD-"), left_pad(F.col("l_orderkey"), 6)).alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.concat(F.lit("PRD"), left_pad(F.col("l_partkey"), 3)).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("product_category"),
            F.when(_every("l_orderkey", 31), "")
            .otherwise(F.concat(F.lit("CUST-"), "o_custkey"))
            .alias("customer_id"),
            F.concat(F.lit("VEND-"), supplier).alias("vendor_id"),
            F.concat(F.lit("WH-"), supplier % 5).alias("warehouse_location"),
            F.when(supplier % 7 == 0, "CHF").otherwise("USD").alias("currency"),
            F.when(_every("o_custkey", 29), F.concat(F.lit("user"), "o_custkey", F.lit("@")))
            .otherwise(F.concat(F.lit("user"), "o_custkey", F.lit("@example.com")))
            .alias("customer_email"),
            F.when(supplier % 10 == 0, F.concat(F.lit("Bay "), supplier))
            .otherwise(F.concat(supplier, F.lit(" Harbour Road")))
            .alias("shipping_address"),
            F.col("l_quantity").cast("int").alias("quantity"),
            "unit_price",
            F.col("l_tax").cast("decimal(4,2)").alias("tax_rate"),
            F.col("l_discount").cast("decimal(4,2)").alias("discount_rate"),
            F.when(F.col("o_orderstatus") == "F", "DELIVERED")
            .when(F.col("o_orderstatus") == "O", "PROCESSING")
            .otherwise("NEW")
            .alias("order_status"),
            F.when(F.col("l_returnflag") == "R", "REFUNDED")
            .when(F.col("l_returnflag") == "A", "PAID")
            .otherwise("PENDING")
            .alias("payment_status"),
            "order_date",
            F.col("l_shipdate").cast("timestamp").alias("ship_date"),
            defect.alias("defect"),
            "l_orderkey",
            "l_suppkey",
        )
        .withColumn(
            "total_amount", (F.col("quantity") * F.col("unit_price") + F.col("defect")).cast(MONEY)
        )
        .withColumns(
            {
                "tax_amount": (F.col("total_amount") * F.col("tax_rate")).cast(MONEY),
                "discount_amount": (F.col("total_amount") * F.col("discount_rate")).cast(MONEY),
                "discount_percentage": (F.col("discount_rate") * 100).cast("decimal(5,2)"),
                "shipping_cost": F.when(F.col("total_amount") > 500, 0)
                .otherwise(10)
                .cast(MONEY),
                "timestamp": F.col("ship_date"),
                "created_at": F.col("order_date"),
            }
        )
    )


def net_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items whose total is the net amount, with the same wrong totals."""
    net = net_amount(
        F.col("quantity"),
        F.col("unit_price"),
        F.col("discount_amount"),
        F.col("tax_amount"),
        F.col("shipping_cost"),
    )
    return order_items(spark, sf_dir).withColumn("total_amount", (net + F.col("defect")).cast(MONEY))


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items as log messages; figures are sent as text, every 37th order is cut in half."""
    rows = order_items(spark, sf_dir)
    day = "yyyy-MM-dd HH:mm:ss"
    sent = F.to_json(
        F.struct(
            "order_id",
            F.when(~_every("l_orderkey", 41), F.col("product_id")).alias("product_id"),
            "customer_id",
            "product_name",
            F.concat(F.col("quantity").cast("string"), F.lit(".0")).alias("quantity"),
            F.col("unit_price").cast("string").alias("unit_price"),
            F.when(_every("l_orderkey", 43), "n/a")
            .otherwise(F.col("total_amount").cast("string"))
            .alias("total_amount"),
            F.col("discount_percentage").cast("string").alias("discount_percentage"),
            F.col("tax_amount").cast("string").alias("tax_amount"),
            F.when(~_every("l_orderkey", 47), F.col("order_status")).alias("order_status"),
            "payment_status",
            F.date_format("order_date", day).alias("order_date"),
            F.date_format("ship_date", day).alias("ship_date"),
            "customer_email",
            "shipping_address",
            "product_category",
            F.col("warehouse_location").alias("warehouse_id"),
            (F.col("defect") == 0).alias("is_valid"),
            F.when(F.col("defect") == 0, 1.0).otherwise(0.8).alias("data_quality_score"),
        )
    )
    return rows.withColumn("sent", sent).select(
        F.encode("order_id", "UTF-8").alias("key"),
        _sent_text(_every("l_orderkey", 37)).alias("value"),
        (F.col("l_suppkey") % 4).cast("int").alias("partition"),
        (F.col("l_orderkey") * 10 + F.col("line_number")).alias("offset"),
        F.col("ship_date").alias("timestamp"),
    )


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = order_log(spark, sf_dir)
    return bronze_ops.to_bronze(log, at=F.col("timestamp"), log_name="purchase-orders")
