"""Views over the log of check runs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.constants import DASHBOARD_FRESH_HOURS, DASHBOARD_STALE_HOURS
from devpulse.functions import round_half_away
from devpulse.operators.aggregates import count_where
from devpulse.operators.joins import latest_year_rows
from devpulse.operators.ordering import order_by_rank


def _rates() -> list[Column]:
    status = F.col("status")
    total, passed = F.count(F.lit(1)), count_where(status == "pass")
    return [
        total.alias("total_tests"),
        passed.alias("passed_tests"),
        count_where(status == "fail").alias("failed_tests"),
        count_where(status == "warn").alias("warned_tests"),
        round_half_away(passed * 100.0 / total, 1).alias("pass_rate_pct"),
        F.sum("failure_count").alias("total_failure_rows"),
    ]


def latest_run(log: DataFrame) -> DataFrame:
    """Results of the newest run."""
    return latest_year_rows(log, "run_at")


def full_outer_health(summary: DataFrame, freshness: DataFrame) -> DataFrame:
    """Models known to the log, to freshness, or to both."""
    return summary.join(freshness, "model_name", "full")


def quality_dashboard(log: DataFrame, freshness: DataFrame) -> DataFrame:
    """Pass rate and freshness per model.  `freshness` has model_name, last_loaded_at and
    hours_since_load."""
    summary = (
        latest_run(log)
        .groupBy("model_name")
        .agg(*_rates(), F.max("run_at").alias("last_tested_at"))
    )
    rate, hours = F.col("pass_rate_pct"), F.col("hours_since_load")
    return full_outer_health(summary, freshness).select(
        "model_name",
        "total_tests",
        "passed_tests",
        "failed_tests",
        "warned_tests",
        "pass_rate_pct",
        "total_failure_rows",
        "last_tested_at",
        "last_loaded_at",
        "hours_since_load",
        F.when(rate >= 95, "healthy")
        .when(rate >= 80, "degraded")
        .when(rate.isNull(), "untested")
        .otherwise("critical")
        .alias("health_status"),
        F.when(hours <= DASHBOARD_FRESH_HOURS, "fresh")
        .when(hours <= DASHBOARD_STALE_HOURS, "stale")
        .when(hours.isNull(), "unknown")
        .otherwise("very_stale")
        .alias("freshness_status"),
    )


def quality_details(log: DataFrame, ordered: bool = True) -> DataFrame:
    """Results of the newest run with a priority, most urgent first."""
    status, severity = F.col("status"), F.col("severity")
    rated = latest_run(log).select(
        "model_name",
        "test_name",
        "column_name",
        "status",
        "failure_count",
        "severity",
        "execution_ms",
        "error_message",
        "run_at",
        F.when((severity == "error") & (status == "fail"), "P1")
        .when((severity == "warn") & (status == "fail"), "P2")
        .when(status == "warn", "P3")
        .otherwise("OK")
        .alias("priority"),
    )
    if not ordered:
        return rated
    return order_by_rank(rated, "priority", ["P1", "P2", "P3"], ["model_name", "test_name"])


def quality_trends(log: DataFrame, ordered: bool = True) -> DataFrame:
    """Pass rate per model and day, newest day first within a model."""
    trends = (
        log.groupBy("model_name", F.to_date("run_at").alias("run_date"))
        .agg(*_rates())
        .drop("warned_tests")
    )
    return trends.orderBy(F.asc("model_name"), F.desc("run_date")) if ordered else trends


def report_totals(log: DataFrame) -> DataFrame:
    """Totals and an overall label for one run."""
    status = F.col("status")
    counts = log.agg(
        F.count(F.lit(1)).alias("total_tests"),
        count_where(status == "pass").alias("passed_tests"),
        count_where(status == "fail").alias("failed_tests"),
        count_where(status == "warn").alias("warned_tests"),
    )
    total = F.nullif(F.col("total_tests"), F.lit(0).cast("long"))
    rate = F.coalesce(F.col("passed_tests") / total * 100, F.lit(0.0))
    return counts.withColumn("pass_rate_pct", round_half_away(rate, 1)).withColumn(
        "overall",
        F.when(rate >= 95, "HEALTHY").when(rate >= 80, "DEGRADED").otherwise("CRITICAL"),
    )


def report_summary(log: DataFrame) -> DataFrame:
    """Pass rate and failures per model of one run."""
    status = F.col("status")
    rate = count_where(status == "pass") / F.count(F.lit(1)) * 100
    return log.groupBy("model_name").agg(
        round_half_away(rate, 1).alias("pass_rate_pct"),
        count_where(status == "fail").alias("failed_tests"),
        (count_where(status == "fail") == 0).alias("is_clean"),
    )
