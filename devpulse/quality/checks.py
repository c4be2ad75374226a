"""Checks that apply to any table."""

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.operators.windows import yoy_prior


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def check_accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Values outside the domain and how often they occur; NULL is not judged."""
    return (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def check_accepted_range(
    df: DataFrame,
    column: str,
    low: float | None = None,
    high: float | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Rows outside [low, high]; NULL is not judged."""
    rows = df if where is None else df.where(where)
    value, outside = F.col(column), F.lit(False)
    if low is not None:
        outside = outside | (value < low)
    if high is not None:
        outside = outside | (value > high)
    return rows.where(outside)


def check_name_standard(df: DataFrame, column: str) -> DataFrame:
    """Names with outer blanks, no text, a version number or an unexpected character."""
    name = F.col(column)
    reason = (
        F.when(name != F.trim(name), "leading_or_trailing_whitespace")
        .when(name == "", "empty_string")
        .when(name.rlike(r"\s+[0-9]+\.?[0-9]*"), "contains_version_number")
        .when(name.rlike(r"[^a-zA-Z0-9\s\-\.\+/\#]"), "invalid_special_character")
    )
    return df.select(
        name.alias("failing_value"),
        F.lit("technology_name_standardization").alias("test_name"),
        reason.alias("failure_reason"),
    ).where(F.col("failure_reason").isNotNull())


def check_response_range(
    df: DataFrame, column: str, low: int = 100, high: int = 300_000
) -> DataFrame:
    """Sample sizes that are too small or too large to be real."""
    value = F.col(column)
    reason = F.when(value < low, f"below_minimum_({low})").when(
        value > high, f"above_maximum_({high})"
    )
    return df.select(
        value.alias("failing_value"),
        F.lit("survey_response_ranges").alias("test_name"),
        reason.alias("failure_reason"),
    ).where(F.col("failure_reason").isNotNull())


def failing(
    rows: DataFrame, columns: Sequence[str | Column], reasons: Sequence[Column]
) -> DataFrame:
    """One output row per reason that holds for a row (a reason is NULL when it does not).
    All reasons of a row are tested in one pass over the data."""
    found = F.explode(F.array_compact(F.array(*reasons))).alias("failure_reason")
    return rows.select(*columns, found)


def check_activity_validity(
    df: DataFrame, column: str, max_share: float = 0.9, max_yoy: float = 10
) -> DataFrame:
    """Negative values, one technology taking nearly everything, and sudden multiples."""
    rows = df.where(F.col(column).isNotNull()).select(
        "technology_name", "year", F.col(column).alias("metric_value")
    )
    rows = rows.withColumn("_prior", yoy_prior("metric_value", ["technology_name"]))
    value, prior = F.col("metric_value"), F.col("_prior")
    return failing(
        rows,
        ["technology_name", "year", "metric_value"],
        [
            F.when(value < 0, "negative_value"),
            F.when(value > max_share, f"exceeds_max_share_({max_share})"),
            F.when((prior > 0) & (value > prior * max_yoy), f"yoy_spike_over_{max_yoy}x"),
        ],
    )
