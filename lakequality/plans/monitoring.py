"""Decisions over quality metrics of order months."""

import datetime

from pyspark.sql import functions as F

from lakequality.operators import analytics, monitor, quality
from lakequality.plans import sql
from lakequality.plans.quality import silver_orders
from lakequality.plans.registry import query


@query(
    "quality_status",
    f"""
WITH {sql.VALIDATED},
overview AS (
  SELECT count(*) AS total_records, count_if(quality_flag = 'PASS') / count(*) AS rate,
         count_if(quality_flag = 'FAIL') AS fails, avg(quality_score) AS score
  FROM validated
)
SELECT total_records, round(rate, 6) AS quality_rate,
       CASE WHEN rate >= 0.95 THEN 'excellent' WHEN rate >= 0.8 THEN 'good'
            WHEN rate >= 0.6 THEN 'needs_attention' ELSE 'critical' END AS quality_status,
       rate >= 0.95 AS meets_threshold,
       concat_ws('; ', CASE WHEN rate < 0.8 THEN 'Review and adjust quality rules' END,
                 CASE WHEN fails > 100 THEN 'Investigate high failure count' END,
                 CASE WHEN score < 0.7 THEN 'Examine data source quality' END) AS recommendations
FROM overview
""",
)
def quality_status(spark, sf_dir):
    overview = analytics.quality_overview(silver_orders(spark, sf_dir))
    return monitor.quality_status(overview).select(
        "total_records", "quality_rate", "quality_status", "meets_threshold", "recommendations"
    )


_METRICS = """
metrics AS (
  SELECT CAST(date_trunc('month', order_date) AS DATE) AS period, count(*) AS total_records,
         CAST(count_if(quality_flag <> 'FAIL') AS BIGINT) AS passed_records,
         CAST(count_if(quality_flag = 'FAIL') AS BIGINT) AS failed_records,
         CAST(count_if(quality_score < 0.9) AS BIGINT) AS low_records,
         count_if(quality_flag <> 'FAIL') / count(*) AS pass_rate,
         count_if(quality_score < 0.9) / count(*) AS low_share
  FROM validated GROUP BY 1
)"""


def monthly_metrics(spark, sf_dir):
    return monitor.collect_metrics(
        silver_orders(spark, sf_dir),
        F.trunc("order_date", "month").alias("period"),
        passed=F.col("quality_flag") != quality.FAIL,
        low=F.col("quality_score") < 0.9,
    )


@query(
    "quality_metrics",
    f"""
WITH {sql.VALIDATED}, {_METRICS}
SELECT period, total_records, passed_records, failed_records, low_records,
       round(pass_rate, 6) AS pass_rate, round(low_share, 6) AS low_share FROM metrics
""",
)
def quality_metrics(spark, sf_dir):
    return monthly_metrics(spark, sf_dir)


@query(
    "metrics_history",
    f"""
WITH {sql.VALIDATED}, {_METRICS}
SELECT period, total_records, passed_records, failed_records FROM metrics
WHERE period BETWEEN DATE '1997-01-01' AND DATE '1999-12-01'
""",
)
def metrics_history(spark, sf_dir):
    metrics = monthly_metrics(spark, sf_dir)
    start, end = datetime.date(1997, 1, 1), datetime.date(1999, 12, 1)
    return monitor.history(metrics, start, end).select(
        "period", "total_records", "passed_records", "failed_records"
    )


@query(
    "quality_alerts",
    f"""
WITH {sql.VALIDATED}, {_METRICS},
told AS (
  SELECT period, pass_rate, low_share,
         concat_ws('; ', CASE WHEN pass_rate < 0.96 THEN 'pass rate below threshold' END,
                   CASE WHEN low_share > 0.3 THEN 'too many low-quality rows' END) AS alert
  FROM metrics
)
SELECT period, round(pass_rate, 6) AS pass_rate, round(low_share, 6) AS low_share, alert
FROM told WHERE alert <> ''
""",
)
def quality_alerts(spark, sf_dir):
    metrics = monthly_metrics(spark, sf_dir)
    return monitor.alerts(metrics, threshold=0.96).select(
        "period", "pass_rate", "low_share", "alert"
    )


@query(
    "quality_anomalies",
    f"""
WITH {sql.VALIDATED}, {_METRICS},
means AS (
  SELECT avg(pass_rate) AS mean_pass_rate, avg(failed_records) AS mean_failed_records
  FROM metrics WHERE period < DATE '2000-01-01'
)
SELECT period, round(pass_rate, 6) AS pass_rate, failed_records,
       round(mean_pass_rate, 6) AS mean_pass_rate, round(mean_failed_records, 6) AS mean_failed_records,
       concat_ws('; ', CASE WHEN pass_rate < mean_pass_rate * 0.99 THEN 'pass_rate below history' END,
         CASE WHEN failed_records > mean_failed_records * 1.25
              THEN 'failed_records above history' END) AS anomalies
FROM metrics, means WHERE period >= DATE '2000-01-01'
""",
)
def quality_anomalies(spark, sf_dir):
    metrics = monthly_metrics(spark, sf_dir)
    border = F.lit("2000-01-01").cast("date")
    return monitor.anomalies(
        metrics.filter(F.col("period") >= border),
        metrics.filter(F.col("period") < border),
        falls={"pass_rate": 0.99},
        rises={"failed_records": 1.25},
    ).select(
        "period",
        "pass_rate",
        "failed_records",
        "mean_pass_rate",
        "mean_failed_records",
        "anomalies",
    )


@query(
    "sla_compliance",
    f"""
WITH {sql.VALIDATED},
metrics AS (
  SELECT warehouse_location, count_if(quality_flag <> 'FAIL') / count(*) AS pass_rate,
         count_if(quality_score < 0.9) / count(*) AS processing_time,
         count(nullif(customer_id, '')) / count(*) AS availability
  FROM validated GROUP BY 1
)
SELECT warehouse_location, round(pass_rate, 6) AS pass_rate,
       round(processing_time, 6) AS processing_time, round(availability, 6) AS availability,
       pass_rate >= 0.95 AS pass_rate_ok, availability >= 0.96 AS availability_ok,
       processing_time <= 0.25 AS processing_time_ok,
       pass_rate >= 0.95 AND availability >= 0.96 AND processing_time <= 0.25 AS overall_ok
FROM metrics
""",
)
def sla_compliance(spark, sf_dir):
    rows = silver_orders(spark, sf_dir)
    total = F.count(F.lit(1))
    metrics = rows.groupBy("warehouse_location").agg(
        (F.count_if(F.col("quality_flag") != quality.FAIL) / total).alias("pass_rate"),
        (F.count_if(F.col("quality_score") < 0.9) / total).alias("processing_time"),
        (F.count_if(F.col("customer_id") != "") / total).alias("availability"),
    )
    return monitor.sla_compliance(
        metrics,
        least={"pass_rate": 0.95, "availability": 0.96},
        most={"processing_time": 0.25},
    )
