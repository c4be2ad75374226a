"""Table profiles."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.functions import round_half_away, to_double
from devpulse.operators.aggregates import grouped_distinct_counts
from devpulse.operators.quantiles import QUARTILES, group_quantiles



def null_report(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Rows, NULLs and NULL percentage per column, worst column first.

    One aggregate over the table gives all counts; only that row is turned into rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("filled"))
            for i, c in enumerate(df.columns)
        ]
    )
    missing = F.col("total_rows") - F.col("filled")
    total = F.nullif(F.col("total_rows"), F.lit(0).cast("long"))
    report = counts.select("total_rows", F.inline(entries)).select(
        "column_name",
        "total_rows",
        missing.alias("null_count"),
        round_half_away(missing / total * 100, 2).alias("null_pct"),
    )
    return report.orderBy(F.desc("null_pct"), F.asc("column_name")) if ordered else report


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once, and their percentage."""
    present = [k for k in keys if k in df.columns]
    groups = df.groupBy(*present).agg(F.count(F.lit(1)).alias("n"))
    totals = groups.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
        F.sum("n").alias("total_rows"),
    )
    share = F.col("duplicate_rows") / F.col("total_rows") * 100
    return totals.withColumn("duplicate_pct", round_half_away(share, 2))


def value_distribution(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The `n` most frequent values, NULL among them; ties by value."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), F.asc_nulls_last("value"))
        .limit(n)
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the smallest and largest number in a column; text that is no
    number is left out.  The last bin includes its upper edge, and empty bins are listed."""
    values = df.select(to_double(F.col(column)).alias("v")).where(F.col("v").isNotNull())
    edges = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).select(
        # a single value gets a bin range of width one around it
        F.when(F.col("low") == F.col("high"), F.col("low") - 0.5)
        .otherwise(F.col("low"))
        .alias("low"),
        F.when(F.col("low") == F.col("high"), F.col("high") + 0.5)
        .otherwise(F.col("high"))
        .alias("high"),
    )
    bounds = edges.select(F.struct("low", "high")).scalar()
    position = (F.col("v") - bounds["low"]) / (bounds["high"] - bounds["low"]) * bins
    counted = (
        values.select(F.least(F.floor(position), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("high") - F.col("low")) / bins
    all_bins = edges.where(F.col("low").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "low", width.alias("width")
    )
    return all_bins.join(counted, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("lower_edge"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("upper_edge"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("row_count"),
    )


def _long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), to_double(F.col(f"`{c}`")).alias("v"))
            for c in columns
        ]
    )
    return df.select(F.inline(entries)).where(F.col("v").isNotNull())


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Mapping[str, float] = QUARTILES,
) -> DataFrame:
    """Exact, interpolated quantiles of whole columns; two passes over the input."""
    return group_quantiles(_long_form(df, columns), ["column_name"], "v", probabilities)


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per column, two digits; two passes."""
    basics = {
        "count": F.count(F.lit(1)),
        "mean": F.avg("v"),
        "std": F.stddev("v"),
        "min": F.min("v"),
        "max": F.max("v"),
    }
    found = group_quantiles(_long_form(df, columns), ["column_name"], "v", further=basics)
    rounded = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return found.select(
        "column_name", "count", *[round_half_away(F.col(c), 2).alias(c) for c in rounded]
    )


def rows_by_year(df: DataFrame, year: str = "survey_year") -> DataFrame:
    return df.groupBy(year).agg(F.count(F.lit(1)).alias("row_count")).orderBy(year)


def fill_rates(df: DataFrame, columns: Sequence[str], year: str = "survey_year") -> DataFrame:
    """Percentage of filled cells per column and year, one digit."""
    rates = df.groupBy(year).agg(
        *[
            round_half_away(F.count(c) / F.count(F.lit(1)) * 100, 1).alias(f"r{i}")
            for i, c in enumerate(columns)
        ]
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"r{i}").alias("fill_pct"))
            for i, c in enumerate(columns)
        ]
    )
    return rates.select(year, F.inline(entries))


def range_and_cardinality(
    df: DataFrame, range_column: str = "activity_month", counted: Sequence[str] = ()
) -> DataFrame:
    """Rows, range of one column and distinct counts of others."""
    basics = {
        "total_rows": ("count", "*"),
        "first_value": ("min", range_column),
        "last_value": ("max", range_column),
    }
    if not counted:
        return df.agg(*[F.expr(f"{kind}({c}) AS {name}") for name, (kind, c) in basics.items()])
    found = grouped_distinct_counts(df, [], basics, {f"distinct_{c}": c for c in counted})
    return found.withColumn("total_rows", F.coalesce("total_rows", F.lit(0)).cast("long"))


def top_by_sum(df: DataFrame, key: str, column: str, n: int = 20) -> DataFrame:
    """The `n` keys with the largest total; ties by key."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum(column).alias("total"))
        .orderBy(F.desc_nulls_last("total"), F.asc(key))
        .limit(n)
    )


def monthly_trend(
    df: DataFrame, month: str = "activity_month", column: str = "event_count"
) -> DataFrame:
    return df.groupBy(month).agg(F.sum(column).alias("events")).orderBy(month)
