"""Row checks: one 0/1 column per rule, for every rule set."""

from pyspark.sql import functions as F

from lakequality.functions import checks
from lakequality.functions.scalars import left_pad
from lakequality.operators import packs, quality, silver
from lakequality.operators.rules import WARN, Rule, RuleSet
from lakequality.plans import sql
from lakequality.plans.registry import query
from lakequality.plans.silver import parsed_readings
from lakequality.sources import samples

ITEM = ["order_id", "line_number", "product_id"]
ITEM_SQL = "order_id, line_number, product_id"


def _rules_sql(source_cte, source, keys, rules):
    return f"WITH {source_cte} SELECT {keys}, {sql.flag_columns(rules)} FROM {source}"


def filled_readings(spark, sf_dir):
    return silver.fill_weather(parsed_readings(spark, sf_dir))


@query(
    "dq_event_rules",
    _rules_sql(sql.FILLED_READINGS, "filled", "source_record_id", sql.WEATHER_RULES),
)
def dq_event_rules(spark, sf_dir):
    rules = packs.weather_rules(samples.EVENTS_AS_OF)
    return quality.rule_flags(filled_readings(spark, sf_dir), rules, ["source_record_id"])


@query(
    "dq_order_rules",
    _rules_sql(
        sql.ORDER_ITEMS,
        "order_items",
        ITEM_SQL,
        [rule for rule in sql.ORDER_RULES if rule[2] == "critical"],
    ),
)
def dq_order_rules(spark, sf_dir):
    return quality.rule_flags(samples.order_items(spark, sf_dir), packs.order_critical(), ITEM)


@query(
    "dq_consistency",
    _rules_sql(
        sql.ORDER_ITEMS,
        "order_items",
        ITEM_SQL + ", order_status, payment_status",
        [rule for rule in sql.ORDER_RULES if rule[2] == "high"],
    ),
)
def dq_consistency(spark, sf_dir):
    keep = [*ITEM, "order_status", "payment_status"]
    return quality.rule_flags(samples.order_items(spark, sf_dir), packs.order_high(), keep)


_FORMATS = [
    *(rule for rule in sql.ORDER_RULES if rule[2] == "medium"),
    ("city_like_length", "warn", "medium", "length(product_name) BETWEEN 2 AND 50", None),
    (
        "phone_format",
        "warn",
        "medium",
        r"regexp_matches(customer_id, '^\d{3}-\d{3}-\d{4}$')",
        None,
    ),
]


@query("dq_format_rules", _rules_sql(sql.ORDER_ITEMS, "order_items", ITEM_SQL, _FORMATS))
def dq_format_rules(spark, sf_dir):
    rules = packs.order_medium() + [
        Rule("city_like_length", checks.length_between("product_name", 2, 50), WARN, "medium"),
        Rule("phone_format", checks.matches("customer_id", checks.PHONE), WARN, "medium"),
    ]
    return quality.rule_flags(samples.order_items(spark, sf_dir), rules, ITEM)


_CATALOG = [
    ("total_amount_calculation_check", "", "", "abs(total_amount - quantity * unit_price) <= 0.01"),
    ("positive_quantity_check", "", "", "quantity > 0"),
    ("positive_unit_price_check", "", "", "unit_price > 0"),
    ("positive_total_amount_check", "", "", "total_amount > 0"),
    ("order_id_not_null_check", "", "", "order_id IS NOT NULL"),
    ("product_id_not_null_check", "", "", "product_id IS NOT NULL"),
    ("customer_id_not_null_check", "", "", "customer_id IS NOT NULL"),
    ("vendor_id_not_null_check", "", "", "vendor_id IS NOT NULL"),
    ("order_id_format_check", "", "", "regexp_matches(order_id, '^ORD-[0-9]{6}$')"),
    ("currency_code_check", "", "", "currency IN ('USD','EUR','GBP','CAD','AUD','JPY')"),
    (
        "order_status_check",
        "",
        "",
        "order_status IN ('NEW','CONFIRMED','PROCESSING','SHIPPED','DELIVERED','CANCELLED')",
    ),
    (
        "payment_status_check",
        "",
        "",
        "payment_status IN ('PENDING','AUTHORIZED','PAID','FAILED','REFUNDED')",
    ),
    ("quantity_reasonable_range_check", "", "", "quantity BETWEEN 1 AND 10000"),
    ("unit_price_reasonable_range_check", "", "", "unit_price BETWEEN 0.01 AND 100000"),
    ("timestamp_not_future_check", "", "", "timestamp <= TIMESTAMP '2001-08-01 00:00:00'"),
    ("created_before_or_equal_timestamp_check", "", "", "created_at <= timestamp"),
]


@query("dq_catalog_rules", _rules_sql(sql.ORDER_ITEMS, "order_items", ITEM_SQL, _CATALOG))
def dq_catalog_rules(spark, sf_dir):
    rules = packs.order_catalog(samples.ORDERS_AS_OF)
    return quality.rule_flags(samples.order_items(spark, sf_dir), rules, ITEM)


@query(
    "dq_time_rules",
    f"""
WITH {sql.ORDER_ITEMS}
SELECT {ITEM_SQL},
       CAST(order_date <= TIMESTAMP '2000-01-01 00:00:00' AS INTEGER) AS order_date_not_future,
       CAST(order_date <= ship_date AS INTEGER) AS ordered_before_shipped
FROM order_items
""",
)
def dq_time_rules(spark, sf_dir):
    rules = RuleSet(
        (
            Rule("order_date_not_future", checks.not_after("order_date", "2000-01-01 00:00:00")),
            Rule("ordered_before_shipped", checks.not_after_column("order_date", "ship_date")),
        )
    )
    return quality.rule_flags(samples.order_items(spark, sf_dir), rules, ITEM)


_MODEL = [
    ("quantity_positive", "error", "critical", "quantity > 0", "Quantity must be positive"),
    ("unit_price_not_negative", "error", "critical", "unit_price >= 0", "Unit price cannot be negative"),
    (
        "net_total_matches",
        "error",
        "critical",
        "abs(total_amount - (quantity * unit_price - discount_amount + tax_amount + shipping_cost))"
        " <= 0.01",
        "Total amount mismatch",
    ),
    (
        "cancelled_not_paid",
        "error",
        "critical",
        "NOT (order_status = 'CANCELLED' AND payment_status = 'PAID')",
        "CANCELLED order with PAID payment",
    ),
    (
        "delivered_not_pending",
        "error",
        "critical",
        "NOT (order_status = 'DELIVERED' AND payment_status = 'PENDING')",
        "DELIVERED order with PENDING payment",
    ),
]


@query(
    "dq_net_total",
    f"""
WITH {sql.NET_ORDERS}, {sql.validated("net_orders", _MODEL)}
SELECT {ITEM_SQL}, failed_rules = 0 AS is_valid, failure_reason,
       round(greatest(0.0::DOUBLE, 1.0::DOUBLE - failed_rules * 0.2::DOUBLE), 6) AS quality_score
FROM validated
""",
)
def dq_net_total(spark, sf_dir):
    rows = quality.validate(
        samples.net_orders(spark, sf_dir), packs.order_model(), score_mode="penalty"
    )
    return rows.select(
        *ITEM, (F.col("failed_rules") == 0).alias("is_valid"), "failure_reason", "quality_score"
    )


def _items_for_schema(spark, sf_dir):
    """Order items under the names of the line-item schema; some quantities are no numbers."""
    status = F.col("order_status")
    return samples.order_items(spark, sf_dir).select(
        F.col("order_id").alias("item_order"),
        F.col("line_number").alias("item_line"),
        F.col("product_id").alias("item_product"),
        F.concat(F.lit("ORD"), left_pad(F.col("l_orderkey"), 8)).alias("order_id"),
        F.concat(F.lit("LINE"), left_pad(F.col("line_number"), 6)).alias("line_item_id"),
        F.concat(F.lit("ITEM"), F.substring("product_id", 4, 12)).alias("item_id"),
        F.when(F.col("l_orderkey") % 9 == 0, "few")
        .otherwise(F.col("quantity").cast("string"))
        .alias("quantity"),
        "unit_price",
        "total_amount",
        F.concat(F.lit("STORE"), left_pad(F.col("l_suppkey"), 3)).alias("store_id"),
        F.when(status == "NEW", "OPEN").otherwise(status).alias("status"),
    )


@query(
    "dq_schema_dict",
    f"""
WITH {sql.ORDER_ITEMS},
items AS (
  SELECT order_id AS item_order, line_number AS item_line, product_id AS item_product,
         'ORD' || {sql.padded('l_orderkey', 8)} AS order_id,
         'LINE' || {sql.padded('line_number', 6)} AS line_item_id,
         'ITEM' || substring(product_id, 4, 12) AS item_id,
         CASE WHEN l_orderkey % 9 = 0 THEN 'few' ELSE CAST(quantity AS VARCHAR) END AS quantity,
         unit_price, total_amount,
         'STORE' || {sql.padded('l_suppkey', 3)} AS store_id,
         CASE WHEN order_status = 'NEW' THEN 'OPEN' ELSE order_status END AS status
  FROM order_items
)
SELECT item_order, item_line, item_product,
       1 AS order_id_required, 1 AS item_id_required, 1 AS quantity_required, 1 AS unit_price_required,
       CAST(regexp_matches(order_id, '^ORD[0-9]{{8}}$') AS INTEGER) AS order_id_pattern,
       CAST(regexp_matches(line_item_id, '^LINE[0-9]{{6}}$') AS INTEGER) AS line_item_id_pattern,
       CAST(regexp_matches(item_id, '^ITEM[0-9]{{5}}$') AS INTEGER) AS item_id_pattern,
       CAST(quantity <> 'few' AS INTEGER) AS quantity_type,
       CAST(coalesce(TRY_CAST(quantity AS DOUBLE) >= 1, true) AS INTEGER) AS quantity_minimum,
       1 AS unit_price_type, CAST(unit_price >= 0 AS INTEGER) AS unit_price_minimum,
       1 AS total_amount_type, CAST(total_amount >= 0 AS INTEGER) AS total_amount_minimum,
       CAST(regexp_matches(store_id, '^STORE[0-9]{{3}}$') AS INTEGER) AS store_id_pattern,
       CAST(status IN ('NEW','PROCESSING','SHIPPED','DELIVERED','CANCELLED') AS INTEGER)
         AS status_enum
FROM items
""",
)
def dq_schema_dict(spark, sf_dir):
    return quality.rule_flags(
        _items_for_schema(spark, sf_dir),
        packs.schema_rules(packs.LINE_ITEM_SCHEMA),
        ["item_order", "item_line", "item_product"],
    )


@query(
    "dq_error_map",
    """
WITH sent AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN 'ORD-12'
              ELSE 'ORD-' || lpad(CAST(l_orderkey AS VARCHAR),
                     greatest(6, length(CAST(l_orderkey AS VARCHAR)))::INTEGER, '0') END AS order_id,
         'PROD-' || l_partkey AS product_id,
         CASE WHEN l_orderkey % 13 = 0 THEN 'two' WHEN l_orderkey % 17 = 0 THEN '-1'
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
         CASE WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_orderkey % 5 = 0 THEN '0'
              ELSE '12.5' END AS unit_price
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       concat_ws('; ',
         CASE WHEN order_id IS NULL THEN 'order_id=order_id is required'
              WHEN NOT regexp_matches(order_id, '^ORD-\\d{6}$')
                THEN 'order_id=Invalid order ID format' END,
         CASE WHEN NOT regexp_matches(product_id, '^PROD-\\w{3,10}$')
                THEN 'product_id=Invalid product ID format' END,
         CASE WHEN TRY_CAST(quantity AS INTEGER) IS NULL
                THEN 'quantity=Quantity must be a valid integer'
              WHEN TRY_CAST(quantity AS INTEGER) <= 0
                THEN 'quantity=Quantity must be positive' END,
         CASE WHEN unit_price IS NULL THEN 'unit_price=unit_price is required'
              WHEN TRY_CAST(unit_price AS DOUBLE) <= 0
                THEN 'unit_price=Unit price must be positive' END) AS errors
FROM sent
""",
)
def dq_error_map(spark, sf_dir):
    key = F.col("l_orderkey")
    sent = samples.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when(key % 7 == 0, F.lit(None).cast("string"))
        .when(key % 11 == 0, "ORD-12")
        .otherwise(F.concat(F.lit("ORD-"), left_pad(key, 6)))
        .alias("order_id"),
        F.concat(F.lit("PROD-"), "l_partkey").alias("product_id"),
        F.when(key % 13 == 0, "two")
        .when(key % 17 == 0, "-1")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("quantity"),
        F.when(key % 19 == 0, F.lit(None).cast("string"))
        .when(key % 5 == 0, "0")
        .otherwise("12.5")
        .alias("unit_price"),
    )
    return sent.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        quality.order_input_errors().alias("errors"),
    )
