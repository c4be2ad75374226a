"""Age of source data."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.functions import days_between, hours_between
from devpulse.operators.aggregates import count_where
from devpulse.operators.ordering import order_by_rank


@dataclass(frozen=True)
class FreshnessSource:
    """A source table and after how many hours it is late and critically late."""

    name: str
    kind: str
    table: DataFrame
    year: Column
    loaded_at: str
    limits: tuple[int, int]


def freshness_measures(sources: Sequence[FreshnessSource], as_of: Column) -> DataFrame:
    """One aggregate row per source: newest year, last load, its age, row and year counts."""
    measured = None
    for s in sources:
        warn, critical = s.limits
        one = s.table.agg(
            F.max(s.year).cast("int").alias("latest_year"),
            F.max(s.loaded_at).alias("last_loaded_at"),
            F.count(F.lit(1)).alias("total_rows"),
            F.count_distinct(s.year).alias("year_count"),
        ).select(
            F.lit(s.name).alias("source_name"),
            F.lit(s.kind).alias("source_type"),
            "latest_year",
            "last_loaded_at",
            hours_between(F.col("last_loaded_at"), as_of).alias("hours_since_load"),
            days_between(F.col("last_loaded_at"), as_of).alias("days_since_load"),
            "total_rows",
            "year_count",
            F.lit(warn).alias("warn_hours"),
            F.lit(critical).alias("critical_hours"),
        )
        measured = one if measured is None else measured.unionByName(one)
    return measured


def freshness_status(
    sources: Sequence[FreshnessSource], as_of: Column, ordered: bool = True
) -> DataFrame:
    """OK, WARNING or CRITICAL per source, with a sentence; worst first."""
    hours, days = F.col("hours_since_load"), F.col("days_since_load").cast("string")
    critical, late = hours >= F.col("critical_hours"), hours >= F.col("warn_hours")

    def stale(level: str) -> Column:
        return F.concat(
            F.lit("Data is "), days, F.lit(f" days old — exceeds {level} threshold")
        )

    rated = freshness_measures(sources, as_of).select(
        "source_name",
        "source_type",
        "latest_year",
        "last_loaded_at",
        "hours_since_load",
        "days_since_load",
        "total_rows",
        "year_count",
        F.when(critical, "CRITICAL").when(late, "WARNING").otherwise("OK").alias(
            "freshness_status"
        ),
        F.when(critical, stale("critical"))
        .when(late, stale("warning"))
        .otherwise(F.concat(F.lit("Data is fresh ("), hours.cast("string"), F.lit(" hours old)")))
        .alias("message"),
    )
    if not ordered:
        return rated
    return order_by_rank(rated, "freshness_status", ["CRITICAL", "WARNING"], ["source_name"])


def freshness_summary(status: DataFrame) -> DataFrame:
    """Sources per status and one overall sentence."""
    state = F.col("freshness_status")
    counts = status.agg(
        count_where(state == "CRITICAL").alias("critical_count"),
        count_where(state == "WARNING").alias("warning_count"),
        count_where(state == "OK").alias("ok_count"),
    )
    return counts.withColumn(
        "overall_status",
        F.when(
            F.col("critical_count") > 0, "ACTION REQUIRED: critical freshness failures detected"
        )
        .when(F.col("warning_count") > 0, "ATTENTION: freshness warnings detected")
        .otherwise("All sources are fresh"),
    )
