"""Reports over Bronze and Silver tables. Each is one aggregate with map-side combining."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakequality.operators.dataset import duplicate_keys
from lakequality.operators.quality import FAIL, PASS, WARNING
from lakequality.session import materialize


def _count() -> Column:
    return F.count(F.lit(1))


def _flagged(flag: str) -> Column:
    return F.count_if(F.col("quality_flag") == flag)


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(_count().alias("n"))


def share_by(df: DataFrame, column: str, score: str) -> DataFrame:
    """Per value: rows, mean, least and greatest score, and the share of all rows.

    The total is a scalar subquery over the aggregated rows, whose exchange both parts share.
    """
    grouped = df.groupBy(column).agg(
        _count().alias("n"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("avg_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )
    return grouped.withColumn("share", F.col("n") / grouped.agg(F.sum("n")).scalar())


def quality_overview(df: DataFrame) -> DataFrame:
    """One row: rows, rows per flag, pass rate, and mean, least and greatest score."""
    return df.agg(
        _count().alias("total_records"),
        _flagged(PASS).alias("pass_records"),
        _flagged(WARNING).alias("warning_records"),
        _flagged(FAIL).alias("fail_records"),
        F.avg("quality_score").alias("avg_score"),
        F.min("quality_score").alias("min_score"),
        F.max("quality_score").alias("max_score"),
    ).withColumn(
        "quality_rate", F.coalesce(F.try_divide("pass_records", "total_records"), F.lit(0.0))
    )


def flag_metrics(df: DataFrame) -> DataFrame:
    return df.groupBy("quality_flag").agg(
        _count().alias("n"),
        F.avg("quality_score").alias("avg_score"),
        F.min("validated_at").alias("first_validation"),
        F.max("validated_at").alias("last_validation"),
    )


def quality_trend(
    df: DataFrame, period: Column, *, since: Column | None = None, until: Column | None = None
) -> DataFrame:
    """Per period: rows, passed, failed, mean score and pass rate in percent.

    `since` and `until` bound the period itself, so a partition column prunes.
    """
    rows = df.withColumn("period", period)
    if since is not None:
        rows = rows.filter(F.col("period") >= since)
    if until is not None:
        rows = rows.filter(F.col("period") <= until)
    return (
        rows.groupBy("period")
        .agg(
            _count().alias("total_records"),
            _flagged(PASS).alias("pass_records"),
            _flagged(FAIL).alias("fail_records"),
            F.avg("quality_score").alias("avg_score"),
        )
        .withColumn("pass_rate", F.col("pass_records") * 100.0 / F.col("total_records"))
    )


def last_days(as_of: Column, days: int) -> Column:
    """First day of a look-back that covers `days` days and the day itself."""
    return F.date_sub(as_of, days)


def trend_summary(trend: DataFrame) -> DataFrame:
    return trend.agg(
        _count().alias("periods"),
        F.sum("total_records").alias("total_records"),
        F.avg("pass_rate").alias("avg_rate"),
        F.min("pass_rate").alias("min_rate"),
        F.max("pass_rate").alias("max_rate"),
    )


def top_groups(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The k most frequent groups; ties go by the group columns."""
    return counts_by(df, *columns).orderBy(F.desc("n"), *columns).limit(k)


def top_failure_reasons(df: DataFrame, k: int = 5) -> DataFrame:
    return top_groups(df.filter(F.col("quality_flag") == FAIL), ["failure_reason"], k)


def failures_by(df: DataFrame, dimensions: Sequence[str], k: int = 5) -> DataFrame:
    """The k values of each dimension with the most failed rows, from one scan.

    The ranking runs on counted values; Spark cuts it to k per dimension before the shuffle.
    """
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias("dimension"), F.col(name).cast("string").alias("value"))
            for name in dimensions
        )
    )
    failed = df.filter(F.col("quality_flag") == FAIL)
    counted = counts_by(failed.select(F.inline(pairs)), "dimension", "value")
    most_first = Window.partitionBy("dimension").orderBy(F.desc("n"), "value")
    ranked = counted.withColumn("place", F.row_number().over(most_first))
    return ranked.filter(F.col("place") <= k)


def financial_failures(df: DataFrame) -> DataFrame:
    """How many failed rows name the total or its calculation as the reason."""
    reason = F.col("failure_reason")
    financial = reason.contains("total_amount") | reason.contains("calculation")
    return df.agg(
        F.count_if((F.col("quality_flag") == FAIL) & financial).alias("financial_failures")
    )


def daily_ingestion(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("ingestion_date").agg(
        _count().alias("n"),
        F.avg("payload_size_bytes").alias("avg_payload_size"),
        F.min("ingestion_timestamp").alias("first_record"),
        F.max("ingestion_timestamp").alias("last_record"),
    )


def partition_analysis(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("log_partition").agg(
        _count().alias("n"),
        F.avg("payload_size_bytes").alias("avg_payload_size"),
        F.min("log_enqueued_at").alias("earliest"),
        F.max("log_enqueued_at").alias("latest"),
    )


def hourly_throughput(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("ingestion_date", "ingestion_hour").agg(
        _count().alias("n"), F.sum("payload_size_bytes").alias("total_bytes")
    )


def payload_stats(bronze: DataFrame) -> DataFrame:
    size = "payload_size_bytes"
    return bronze.agg(
        F.avg(size).alias("avg_size"), F.min(size).alias("min_size"), F.max(size).alias("max_size")
    )


def payload_patterns(bronze: DataFrame, k: int = 20, prefix: int = 50) -> DataFrame:
    """The k most frequent pairs of payload size and leading characters."""
    sample = F.substring("raw_payload", 1, prefix).alias("sample")
    return top_groups(bronze.select("payload_size_bytes", sample), ["payload_size_bytes", "sample"], k)


def status_distribution(df: DataFrame, k: int = 10) -> DataFrame:
    known = df.filter(F.col("order_status").isNotNull())
    return top_groups(known, ["order_status", "payment_status"], k)


def financial_summary(df: DataFrame, amount: str = "total_amount") -> DataFrame:
    return df.filter(F.col(amount).isNotNull()).agg(
        _count().alias("total_orders"),
        F.sum(amount).alias("total_revenue"),
        F.avg(amount).alias("avg_order_value"),
        F.min(amount).alias("min_order"),
        F.max(amount).alias("max_order"),
    )


_FUNCTIONS = {
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "count_distinct": F.count_distinct,
}


def aggregate_by(
    df: DataFrame, groups: Sequence[str], aggregations: Mapping[str, str]
) -> DataFrame:
    """Aggregates named by a dictionary: column to function, as `<function>_<column>`."""
    unknown = sorted(set(aggregations.values()) - set(_FUNCTIONS))
    if unknown:
        raise ValueError(f"unknown aggregate: {', '.join(unknown)}")
    return df.groupBy(*groups).agg(
        *(_FUNCTIONS[name](column).alias(f"{name}_{column}") for column, name in aggregations.items())
    )


def having(df: DataFrame, groups: Sequence[str], amount: str, least) -> DataFrame:
    """Sum and mean per group, for the groups whose sum is above `least`."""
    return aggregate_sum_avg(df, groups, amount).filter(F.col(f"sum_{amount}") > least)


def aggregate_sum_avg(df: DataFrame, groups: Sequence[str], amount: str) -> DataFrame:
    return df.groupBy(*groups).agg(
        F.sum(amount).alias(f"sum_{amount}"), F.avg(amount).alias(f"avg_{amount}")
    )


def customer_value(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_id").agg(
        _count().alias("order_count"), F.sum("total_amount").alias("total_value")
    )


def vendor_warehouse(df: DataFrame, score: str = "quality_score") -> DataFrame:
    return df.groupBy("vendor_id", "warehouse_location").agg(
        _count().alias("order_count"),
        F.sum("total_amount").alias("total_value"),
        F.avg(score).alias("avg_quality"),
    )


def batch_metrics(df: DataFrame, valid: Column) -> DataFrame:
    return df.agg(
        _count().alias("total_processed"),
        F.sum(valid.cast("int")).alias("total_valid"),
        F.avg("total_amount").alias("avg_order_value"),
    )


def batch_statistics(df: DataFrame, valid: Column) -> DataFrame:
    """One row of batch figures, with the rows per status as a map.

    Grouping by status first keeps the second aggregate to a handful of rows.
    """
    per_status = df.groupBy("order_status").agg(
        _count().alias("n"),
        F.count_if(valid).alias("valid"),
        F.sum("total_amount").alias("revenue"),
        F.min("total_amount").alias("least"),
        F.max("total_amount").alias("most"),
    )
    entry = F.struct(F.coalesce("order_status", F.lit("")), F.col("n"))
    return per_status.agg(
        F.sum("n").alias("total_orders"),
        F.sum("valid").alias("valid_orders"),
        (F.sum("n") - F.sum("valid")).alias("invalid_orders"),
        (F.sum("valid") / F.sum("n")).alias("quality_rate"),
        F.sum("revenue").alias("total_revenue"),
        (F.sum("revenue") / F.sum("n")).alias("average_order_value"),
        F.min("least").alias("min_order_value"),
        F.max("most").alias("max_order_value"),
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("status_distribution"),
    )


def silver_metrics(df: DataFrame) -> DataFrame:
    return df.agg(
        _count().alias("record_count"),
        F.count_distinct("order_id").alias("distinct_orders"),
        F.sum("total_amount").alias("total_amount"),
    )


def quality_report(
    df: DataFrame, dimensions: Mapping[str, Column], unique_keys: Sequence[str] = ()
) -> DataFrame:
    """Rows, failures per quality dimension, and the pass rate the failures leave, in percent.

    A row that fails in two dimensions counts twice, as reports of this kind do; with
    `unique_keys`, each repeated key is one failure more; the checks and the keys are then written
    down once for both counts.
    """
    names = list(dimensions)
    checked = {f"{name}_failures": ~F.coalesce(good, F.lit(False)) for name, good in dimensions.items()}
    if unique_keys:
        df = materialize(
            df.select(*unique_keys, *(bad.alias(name) for name, bad in checked.items())), "report-checks"
        )
        checked = {name: F.col(name) for name in checked}
    failures = [F.count_if(bad).alias(name) for name, bad in checked.items()]
    report = df.agg(_count().alias("total_records"), *failures)
    if unique_keys:
        names.append("uniqueness")
        repeated = duplicate_keys(df, unique_keys).agg(_count()).scalar()
        report = report.withColumn("uniqueness_failures", repeated)
    total_failures = sum((F.col(f"{name}_failures") for name in names), F.lit(0))
    return (
        report.withColumn("rules_executed", F.lit(len(names)))
        .withColumn(
            "pass_rate",
            (F.col("total_records") - total_failures) * 100.0 / F.col("total_records"),
        )
    )


def validated_summary(df: DataFrame) -> DataFrame:
    """Counts, score, latest validation and whether a validated table has issues."""
    return df.agg(
        _count().alias("total_records"),
        F.count_if("is_valid").alias("valid_records"),
        F.try_divide(F.count_if("is_valid"), _count()).alias("quality_score"),
        F.max("validated_at").alias("latest_validation"),
    ).withColumns(
        {
            "invalid_records": F.col("total_records") - F.col("valid_records"),
            "quality_percentage": F.col("quality_score") * 100,
            "has_quality_issues": F.col("valid_records") < F.col("total_records"),
        }
    )


def latest_rows(df: DataFrame, time: str, n: int, *tiebreak: str) -> DataFrame:
    """The n newest rows, as a distributed top-n."""
    return df.orderBy(F.desc(time), *tiebreak).limit(n)


def earliest_rows(df: DataFrame, time: str, n: int, *tiebreak: str) -> DataFrame:
    return df.orderBy(time, *tiebreak).limit(n)


def fragment_pieces(
    df: DataFrame, key: str, order: str, line: str, *, field: str = "response", span: int = 10_000
) -> DataFrame:
    """Text of JSON lines joined per key and `span` of the order: (key, piece, text).

    Blank and malformed lines add nothing, a missing field counts as empty text. A key with very
    many lines is spread over as many tasks as it has pieces.
    """
    schema = f"{field} STRING, broken STRING"
    read = F.from_json(line, schema, {"columnNameOfCorruptRecord": "broken"})
    return (
        df.select(key, order, read.alias("read"))
        .select(
            key,
            order,
            F.floor(F.col(order) / span).alias("piece"),
            F.when(F.col("read.broken").isNull(), F.col(f"read.{field}")).alias("text"),
        )
        .groupBy(key, "piece")
        .agg(_joined_text(order).alias("text"))
    )


def concat_fragments(
    df: DataFrame, key: str, order: str, line: str, *, field: str = "response", span: int = 10_000
) -> DataFrame:
    """The whole text per key: its finished pieces in order.

    The result is one value per key by definition; `fragment_pieces` keeps longer texts apart.
    """
    pieces = fragment_pieces(df, key, order, line, field=field, span=span)
    return pieces.groupBy(key).agg(_joined_text("piece").alias("text"))


def _joined_text(position: str) -> Column:
    ordered = F.sort_array(F.collect_list(F.struct(position, "text")))
    return F.array_join(F.transform(ordered, lambda item: item["text"]), "")
