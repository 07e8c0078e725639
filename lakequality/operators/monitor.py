"""Decisions over quality metrics: status, recommendations, alerts, anomalies, service levels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequality.functions.scalars import ladder
from lakequality.operators.quality import THRESHOLD

# Steps of the status and limits of the recommendations.
STATUS_STEPS = ((0.95, "excellent"), (0.8, "good"), (0.6, "needs_attention"))
STATUS_DEFAULT = "critical"
LOW_RATE, MANY_FAILURES, LOW_SCORE = 0.8, 100, 0.7
LOW_QUALITY_SHARE = 0.3
ADVICE = {
    "rate": "Review and adjust quality rules",
    "failures": "Investigate high failure count",
    "score": "Examine data source quality",
}


def quality_status(overview: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Status, threshold verdict and recommendations beside the overview figures."""
    rate = F.col("quality_rate")
    advice = F.concat_ws(
        "; ",
        F.when(rate < LOW_RATE, ADVICE["rate"]),
        F.when(F.col("fail_records") > MANY_FAILURES, ADVICE["failures"]),
        F.when(F.col("avg_score") < LOW_SCORE, ADVICE["score"]),
    )
    return overview.withColumns(
        {
            "quality_status": ladder(rate, STATUS_STEPS, STATUS_DEFAULT, inclusive=True),
            "meets_threshold": rate >= threshold,
            "recommendations": advice,
        }
    )


def collect_metrics(df: DataFrame, *periods: Column, passed: Column, low: Column) -> DataFrame:
    """Rows, passed, failed and pass rate per period, and the share of low-quality rows."""
    grouped = df.groupBy(*periods) if periods else df
    return grouped.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(passed).alias("passed_records"),
        F.count_if(~passed).alias("failed_records"),
        F.count_if(low).alias("low_records"),
    ).withColumns(
        {
            "pass_rate": F.try_divide("passed_records", "total_records"),
            "low_share": F.try_divide("low_records", "total_records"),
        }
    )


def alerts(
    metrics: DataFrame,
    *,
    threshold: float = THRESHOLD,
    low_share: float = LOW_QUALITY_SHARE,
) -> DataFrame:
    """The periods that call for an alert, with the reasons."""
    reasons = F.concat_ws(
        "; ",
        F.when(F.col("pass_rate") < threshold, "pass rate below threshold"),
        F.when(F.col("low_share") > low_share, "too many low-quality rows"),
    )
    return metrics.withColumn("alert", reasons).filter("alert <> ''")


def anomalies(
    current: DataFrame,
    history: DataFrame,
    *,
    falls: Mapping[str, float] | None = None,
    rises: Mapping[str, float] | None = None,
) -> DataFrame:
    """Current metrics against their historic means.

    `falls` maps a metric to the share of its mean it must not fall below, `rises` to the multiple
    it must not exceed. The means are scalar subqueries, one value each.
    """
    falls, rises = falls or {}, rises or {}
    means = {
        f"mean_{name}": history.agg(F.avg(name)).scalar() for name in dict.fromkeys((*falls, *rises))
    }
    reasons = [
        F.when(F.col(name) < F.col(f"mean_{name}") * factor, f"{name} below history")
        for name, factor in falls.items()
    ] + [
        F.when(F.col(name) > F.col(f"mean_{name}") * factor, f"{name} above history")
        for name, factor in rises.items()
    ]
    return current.withColumns(means).withColumn("anomalies", F.concat_ws("; ", *reasons))


def sla_compliance(
    metrics: DataFrame, *, least: Mapping[str, float], most: Mapping[str, float]
) -> DataFrame:
    """Per metric and overall: is the target met?"""
    verdicts = {
        **{f"{name}_ok": F.col(name) >= target for name, target in least.items()},
        **{f"{name}_ok": F.col(name) <= target for name, target in most.items()},
    }
    overall = F.lit(True)
    for name in verdicts:
        overall = overall & F.col(name)
    return metrics.withColumns(verdicts).withColumn("overall_ok", overall)


def history(metrics: DataFrame, start, end, period: str = "period") -> DataFrame:
    """Metrics of a range of periods, both ends included."""
    return metrics.filter(F.col(period).between(F.lit(start), F.lit(end)))
