"""Reports over validated orders, readings and Bronze events."""

from pyspark.sql import functions as F

from lakequality.functions import checks
from lakequality.operators import analytics, packs, quality
from lakequality.operators.rules import Rule
from lakequality.plans import sql
from lakequality.plans.quality import silver_orders, silver_verdicts, validated_readings
from lakequality.plans.registry import query
from lakequality.plans.silver import parsed_readings
from lakequality.sources import files, samples


@query(
    "flag_distribution",
    f"WITH {sql.VALIDATED_READINGS} SELECT quality_flag, count(*) AS n FROM validated GROUP BY 1",
)
def flag_distribution(spark, sf_dir):
    return analytics.counts_by(validated_readings(spark, sf_dir), "quality_flag")


@query(
    "quality_overview",
    f"""
WITH {sql.VALIDATED}
SELECT count(*) AS total_records,
       CAST(count_if(quality_flag = 'PASS') AS BIGINT) AS pass_records,
       CAST(count_if(quality_flag = 'WARNING') AS BIGINT) AS warning_records,
       CAST(count_if(quality_flag = 'FAIL') AS BIGINT) AS fail_records,
       round(avg(quality_score), 6) AS avg_score, round(min(quality_score), 6) AS min_score,
       round(max(quality_score), 6) AS max_score,
       round(count_if(quality_flag = 'PASS') / count(*), 6) AS quality_rate
FROM validated
""",
)
def quality_overview(spark, sf_dir):
    return analytics.quality_overview(silver_orders(spark, sf_dir))


@query(
    "flag_by_criticality",
    f"""
WITH {sql.VALIDATED}
SELECT quality_flag, criticality, count(*) AS n FROM validated GROUP BY 1, 2
""",
)
def flag_by_criticality(spark, sf_dir):
    return analytics.counts_by(silver_orders(spark, sf_dir), "quality_flag", "criticality")


@query(
    "flag_metrics",
    f"""
WITH {sql.VALIDATED}
SELECT quality_flag, count(*) AS n, round(avg(quality_score), 6) AS avg_score,
       min(ship_date) AS first_validation, max(ship_date) AS last_validation
FROM validated GROUP BY 1
""",
)
def flag_metrics(spark, sf_dir):
    return analytics.flag_metrics(silver_orders(spark, sf_dir))


_TREND = """
trend AS (
  SELECT {period} AS period, count(*) AS total_records,
         CAST(count_if(quality_flag = 'PASS') AS BIGINT) AS pass_records,
         CAST(count_if(quality_flag = 'FAIL') AS BIGINT) AS fail_records,
         avg(quality_score) AS avg_score,
         count_if(quality_flag = 'PASS') * 100.0::DOUBLE / count(*) AS pass_rate
  FROM validated {where} GROUP BY 1
)"""
_MONTHS = _TREND.format(period="CAST(date_trunc('month', order_date) AS DATE)", where="")
_WEEK = _TREND.format(
    period="CAST(order_date AS DATE)", where="WHERE order_date >= TIMESTAMP '2001-07-25 00:00:00'"
)
_TREND_COLUMNS = (
    "period, total_records, pass_records, fail_records, round(avg_score, 6) AS avg_score, "
    "round(pass_rate, 6) AS pass_rate"
)


def monthly_trend(spark, sf_dir):
    month = F.trunc("order_date", "month")
    return analytics.quality_trend(silver_orders(spark, sf_dir), month)


@query("quality_trend", f"WITH {sql.VALIDATED}, {_MONTHS} SELECT {_TREND_COLUMNS} FROM trend")
def quality_trend(spark, sf_dir):
    return monthly_trend(spark, sf_dir)


@query("recent_trend", f"WITH {sql.VALIDATED}, {_WEEK} SELECT {_TREND_COLUMNS} FROM trend")
def recent_trend(spark, sf_dir):
    as_of = samples.at(samples.ORDERS_AS_OF)
    return analytics.quality_trend(
        silver_orders(spark, sf_dir),
        F.to_date("order_date"),
        since=analytics.last_days(F.to_date(as_of), 7),
    )


@query(
    "trend_summary",
    f"""
WITH {sql.VALIDATED}, {_MONTHS}
SELECT count(*) AS periods, CAST(sum(total_records) AS BIGINT) AS total_records,
       round(avg(pass_rate), 6) AS avg_rate, round(min(pass_rate), 6) AS min_rate,
       round(max(pass_rate), 6) AS max_rate
FROM trend
""",
)
def trend_summary(spark, sf_dir):
    return analytics.trend_summary(monthly_trend(spark, sf_dir))


@query(
    "top_failure_reasons",
    f"""
WITH {sql.VALIDATED}
SELECT failure_reason, count(*) AS n FROM validated WHERE quality_flag = 'FAIL'
GROUP BY 1 ORDER BY n DESC, failure_reason LIMIT 5
""",
)
def top_failure_reasons(spark, sf_dir):
    return analytics.top_failure_reasons(silver_verdicts(spark, sf_dir))


@query(
    "failures_by_dimension",
    f"""
WITH {sql.VALIDATED},
pairs AS (
  SELECT 'product_category' AS dimension, product_category AS value FROM validated
  WHERE quality_flag = 'FAIL'
  UNION ALL
  SELECT 'order_status', order_status FROM validated WHERE quality_flag = 'FAIL'
),
counted AS (SELECT dimension, value, count(*) AS n FROM pairs GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value) AS place FROM counted
)
SELECT dimension, value, n, CAST(place AS INTEGER) AS place FROM ranked WHERE place <= 5
""",
)
def failures_by_dimension(spark, sf_dir):
    return analytics.failures_by(
        silver_orders(spark, sf_dir), ["product_category", "order_status"]
    )


@query(
    "financial_failures",
    f"""
WITH {sql.VALIDATED}
SELECT CAST(count_if(quality_flag = 'FAIL' AND (contains(failure_reason, 'total_amount')
         OR contains(failure_reason, 'calculation'))) AS BIGINT) AS financial_failures
FROM validated
""",
)
def financial_failures(spark, sf_dir):
    return analytics.financial_failures(silver_orders(spark, sf_dir))


@query(
    "parsing_status_counts",
    f"WITH {sql.READINGS} SELECT parsing_status, count(*) AS n FROM readings GROUP BY 1",
)
def parsing_status_counts(spark, sf_dir):
    return analytics.counts_by(parsed_readings(spark, sf_dir), "parsing_status")


@query(
    "daily_ingestion",
    f"""
WITH {sql.BRONZE}
SELECT ingestion_date, count(*) AS n, round(avg(payload_size_bytes), 6) AS avg_payload_size,
       min(ingestion_timestamp) AS first_record, max(ingestion_timestamp) AS last_record
FROM bronze GROUP BY 1
""",
)
def daily_ingestion(spark, sf_dir):
    return analytics.daily_ingestion(samples.bronze_events(spark, sf_dir))


@query(
    "partition_analysis",
    f"""
WITH {sql.BRONZE}
SELECT log_partition, count(*) AS n, round(avg(payload_size_bytes), 6) AS avg_payload_size,
       min(log_enqueued_at) AS earliest, max(log_enqueued_at) AS latest
FROM bronze GROUP BY 1
""",
)
def partition_analysis(spark, sf_dir):
    return analytics.partition_analysis(samples.bronze_events(spark, sf_dir))


@query(
    "hourly_throughput",
    f"""
WITH {sql.BRONZE}
SELECT ingestion_date, ingestion_hour, count(*) AS n,
       CAST(sum(payload_size_bytes) AS BIGINT) AS total_bytes
FROM bronze GROUP BY 1, 2
""",
)
def hourly_throughput(spark, sf_dir):
    return analytics.hourly_throughput(samples.bronze_events(spark, sf_dir))


@query(
    "payload_stats",
    f"""
WITH {sql.BRONZE}
SELECT round(avg(payload_size_bytes), 6) AS avg_size, min(payload_size_bytes) AS min_size,
       max(payload_size_bytes) AS max_size
FROM bronze
""",
)
def payload_stats(spark, sf_dir):
    return analytics.payload_stats(samples.bronze_events(spark, sf_dir))


@query(
    "payload_patterns",
    f"""
WITH {sql.BRONZE}
SELECT payload_size_bytes, left(raw_payload, 50) AS sample, count(*) AS n
FROM bronze GROUP BY 1, 2 ORDER BY n DESC, payload_size_bytes, sample LIMIT 20
""",
)
def payload_patterns(spark, sf_dir):
    return analytics.payload_patterns(samples.bronze_events(spark, sf_dir))


@query(
    "quality_by_validity",
    f"""
WITH {sql.VALIDATED},
grouped AS (
  SELECT CASE WHEN quality_flag = 'FAIL' THEN 'false' ELSE 'true' END AS is_valid,
         count(*) AS n, avg(quality_score) AS avg_score, min(quality_score) AS min_score,
         max(quality_score) AS max_score
  FROM validated GROUP BY 1
)
SELECT is_valid, n, round(avg_score, 6) AS avg_score, round(min_score, 6) AS min_score,
       round(max_score, 6) AS max_score, round(n / sum(n) OVER (), 6) AS share
FROM grouped
""",
)
def quality_by_validity(spark, sf_dir):
    rows = silver_orders(spark, sf_dir).withColumn(
        "is_valid", F.when(F.col("quality_flag") == quality.FAIL, "false").otherwise("true")
    )
    return analytics.share_by(rows, "is_valid", "quality_score")


@query(
    "sql_source",
    f"""
WITH {sql.VALIDATED}
SELECT quality_flag, payment_status, count(*) AS n, CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM validated GROUP BY quality_flag, payment_status
""",
)
def sql_source(spark, sf_dir):
    return files.read_sql(
        spark,
        "SELECT quality_flag, payment_status, count(*) AS n, sum(total_amount) AS revenue "
        "FROM {silver} GROUP BY quality_flag, payment_status",
        silver=silver_orders(spark, sf_dir),
    )


@query(
    "status_distribution",
    f"""
WITH {sql.ORDER_ITEMS}
SELECT order_status, payment_status, count(*) AS n
FROM order_items WHERE order_status IS NOT NULL
GROUP BY 1, 2 ORDER BY n DESC, order_status, payment_status LIMIT 10
""",
)
def status_distribution(spark, sf_dir):
    return analytics.status_distribution(samples.order_items(spark, sf_dir))


@query(
    "financial_summary",
    f"""
WITH {sql.ORDER_ITEMS}
SELECT count(*) AS total_orders, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       round(avg(total_amount), 6) AS avg_order_value, CAST(min(total_amount) AS DOUBLE) AS min_order,
       CAST(max(total_amount) AS DOUBLE) AS max_order
FROM order_items WHERE total_amount IS NOT NULL
""",
)
def financial_summary(spark, sf_dir):
    return analytics.financial_summary(samples.order_items(spark, sf_dir))


@query(
    "customer_value",
    f"""
WITH {sql.ORDER_ITEMS}
SELECT customer_id, count(*) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS total_value
FROM order_items GROUP BY 1
""",
)
def customer_value(spark, sf_dir):
    return analytics.customer_value(samples.order_items(spark, sf_dir))


@query(
    "vendor_warehouse",
    f"""
WITH {sql.VALIDATED}
SELECT vendor_id, warehouse_location, count(*) AS order_count,
       CAST(sum(total_amount) AS DOUBLE) AS total_value, round(avg(quality_score), 6) AS avg_quality
FROM validated GROUP BY 1, 2
""",
)
def vendor_warehouse(spark, sf_dir):
    return analytics.vendor_warehouse(silver_orders(spark, sf_dir))


@query(
    "batch_metrics",
    f"""
WITH {sql.VALIDATED}
SELECT count(*) AS total_processed, CAST(count_if(quality_flag <> 'FAIL') AS BIGINT) AS total_valid,
       round(avg(total_amount), 6) AS avg_order_value
FROM validated
""",
)
def batch_metrics(spark, sf_dir):
    valid = F.col("quality_flag") != quality.FAIL
    return analytics.batch_metrics(silver_orders(spark, sf_dir), valid)


@query(
    "batch_statistics",
    f"""
WITH {sql.VALIDATED},
statuses AS (SELECT order_status, count(*) AS n FROM validated GROUP BY 1)
SELECT count(*) AS total_orders, CAST(count_if(quality_flag <> 'FAIL') AS BIGINT) AS valid_orders,
       CAST(count_if(quality_flag = 'FAIL') AS BIGINT) AS invalid_orders,
       round(count_if(quality_flag <> 'FAIL') / count(*), 6) AS quality_rate,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       round(avg(total_amount), 6) AS average_order_value,
       CAST(min(total_amount) AS DOUBLE) AS min_order_value,
       CAST(max(total_amount) AS DOUBLE) AS max_order_value,
       (SELECT string_agg(order_status || '=' || n, '; ' ORDER BY order_status) FROM statuses)
         AS status_distribution
FROM validated
""",
)
def batch_statistics(spark, sf_dir):
    valid = F.col("quality_flag") != quality.FAIL
    return analytics.batch_statistics(silver_orders(spark, sf_dir), valid)


@query(
    "batch_counts",
    """
SELECT CAST(o_orderkey % 10 AS INTEGER) AS batch_id, count(*) AS n FROM orders GROUP BY 1
""",
)
def batch_counts(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "orders")
    tagged = rows.withColumn("batch_id", (F.col("o_orderkey") % 10).cast("int"))
    return analytics.counts_by(tagged, "batch_id")


@query(
    "silver_metrics",
    f"""
WITH {sql.ORDER_ITEMS}
SELECT count(*) AS record_count, count(DISTINCT order_id) AS distinct_orders,
       CAST(sum(total_amount) AS DOUBLE) AS total_amount
FROM order_items
""",
)
def silver_metrics(spark, sf_dir):
    return analytics.silver_metrics(samples.order_items(spark, sf_dir))


@query(
    "dynamic_agg",
    f"""
WITH {sql.ORDER_ITEMS}
SELECT product_id, warehouse_location, CAST(sum(total_amount) AS DOUBLE) AS sum_total_amount,
       count(order_id) AS count_order_id, round(avg(quantity), 6) AS avg_quantity,
       count(DISTINCT vendor_id) AS count_distinct_vendor_id
FROM order_items GROUP BY 1, 2
""",
)
def dynamic_agg(spark, sf_dir):
    return analytics.aggregate_by(
        samples.order_items(spark, sf_dir),
        ["product_id", "warehouse_location"],
        {
            "total_amount": "sum",
            "order_id": "count",
            "quantity": "avg",
            "vendor_id": "count_distinct",
        },
    )


@query(
    "having_filter",
    f"""
WITH {sql.ORDER_ITEMS}
SELECT product_id, CAST(sum(total_amount) AS DOUBLE) AS sum_total_amount,
       round(avg(total_amount), 6) AS avg_total_amount
FROM order_items GROUP BY 1 HAVING sum(total_amount) > 600000
""",
)
def having_filter(spark, sf_dir):
    rows = samples.order_items(spark, sf_dir)
    return analytics.having(rows, ["product_id"], "total_amount", 600000)


@query(
    "dq_report",
    f"""
WITH {sql.ORDER_ITEMS},
figures AS (
  SELECT count(*) AS total_records,
         count_if(NOT (order_id <> '' AND customer_id <> '')) AS completeness_failures,
         count_if(NOT quantity > 0) AS validity_failures,
         count_if(NOT abs(total_amount - quantity * unit_price) <= 0.01) AS consistency_failures,
         count_if(NOT regexp_matches(customer_email, '{sql.EMAIL}')) AS format_failures
  FROM order_items
),
repeated AS (SELECT order_id, line_number FROM order_items GROUP BY ALL HAVING count(*) > 1),
combined AS (
  SELECT *, (SELECT count(*) FROM repeated) AS uniqueness_failures FROM figures
)
SELECT total_records, CAST(completeness_failures AS BIGINT) AS completeness_failures,
       CAST(validity_failures AS BIGINT) AS validity_failures,
       CAST(consistency_failures AS BIGINT) AS consistency_failures,
       CAST(format_failures AS BIGINT) AS format_failures, uniqueness_failures, 5 AS rules_executed,
       round((total_records - completeness_failures - validity_failures - consistency_failures
              - format_failures - uniqueness_failures) * 100.0::DOUBLE / total_records, 6) AS pass_rate
FROM combined
""",
)
def dq_report(spark, sf_dir):
    dimensions = {
        "completeness": checks.sql("order_id <> '' AND customer_id <> ''"),
        "validity": checks.greater_than("quantity", 0),
        "consistency": checks.equals("total_amount", "quantity * unit_price"),
        "format": checks.matches("customer_email", checks.EMAIL),
    }
    return analytics.quality_report(
        samples.order_items(spark, sf_dir), dimensions, ["order_id", "line_number"]
    )


@query(
    "dq_summary",
    f"""
WITH {sql.ORDER_ITEMS},
checked AS (
  SELECT ship_date, quantity > 0 AND unit_price > 0 AND total_amount > 0 AND customer_id <> ''
    AS is_valid
  FROM order_items
)
SELECT count(*) AS total_records, CAST(count_if(is_valid) AS BIGINT) AS valid_records,
       round(count_if(is_valid) / count(*), 6) AS quality_score,
       max(ship_date) AS latest_validation,
       CAST(count(*) - count_if(is_valid) AS BIGINT) AS invalid_records,
       round(count_if(is_valid) / count(*) * 100, 6) AS quality_percentage,
       count_if(is_valid) < count(*) AS has_quality_issues
FROM checked
""",
)
def dq_summary(spark, sf_dir):
    rules = packs.order_minimal() + [Rule("customer_filled", "customer_id <> ''")]
    rows = samples.order_items(spark, sf_dir)
    marked = quality.mark_valid(rows, rules)
    return analytics.validated_summary(marked.withColumn("validated_at", F.col("ship_date")))


@query(
    "fragment_concat",
    """
SELECT conv_id,
       coalesce(string_agg(
         CASE WHEN (conv_id * 31 + turn) % 11 = 0 OR (conv_id * 31 + turn) % 13 = 0 THEN ''
              WHEN (conv_id * 31 + turn) % 7 = 0 THEN '' ELSE text END, '' ORDER BY turn), '') AS text
FROM conversations GROUP BY conv_id
""",
)
def fragment_concat(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "conversations")
    number = F.col("conv_id") * 31 + F.col("turn")
    whole = F.to_json(F.struct(F.col("text").alias("response")))
    other = F.to_json(F.struct(F.col("text").alias("note")))
    half = F.substr(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))
    line = (
        F.when(number % 11 == 0, half)
        .when(number % 13 == 0, "")
        .when(number % 7 == 0, other)
        .otherwise(whole)
    )
    lines = rows.select("conv_id", "turn", line.alias("line"))
    return analytics.concat_fragments(lines, "conv_id", "turn", "line")
