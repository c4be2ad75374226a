"""Window operators.

They run on yearly marts, where a partition (one technology, or one technology of one source)
holds as many rows as there are years.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devpulse.functions import ratio
from devpulse.operators.aggregates import weighted_percentiles


def dedup_mapping(
    df: DataFrame, key: str = "source_name", order: Sequence[str] = ("canonical_name",)
) -> DataFrame:
    """One row per key, the first by `order`.

    Smallest-row-wins is an aggregate with map-side combine, so a name listed any number of
    times costs one row per task instead of a sorted window partition.  Ties in `order` are
    settled by the remaining columns."""
    rest = [c for c in df.columns if c not in (key, *order)]
    best = F.min(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(key).agg(best).select(key, "_row.*").select(*df.columns)


def share_of_year(df: DataFrame, shares: Mapping[str, str], year: str) -> DataFrame:
    """`df` with the shares (by name, of which column) in the year's total.  Totals are an
    aggregate with map-side combine, a row a year, so no task gets a year's rows."""
    totals = df.groupBy(F.col(year).alias("_year")).agg(
        *[F.sum(c).alias(f"_{name}") for name, c in shares.items()]
    )
    joined = df.join(totals, F.col(year).eqNullSafe(F.col("_year")))
    return joined.select(
        *df.columns, *[ratio(F.col(c), F.col(f"_{name}")).alias(name) for name, c in shares.items()]
    )


def yoy_prior(column: str, partition: Sequence[str], year: str = "year") -> Column:
    """Value in the previous row of the partition (missing years are skipped)."""
    return F.lag(column).over(Window.partitionBy(*partition).orderBy(year))


def yoy_delta(
    column: str, partition: Sequence[str] = ("technology_name",), year: str = "year"
) -> Column:
    return F.col(column) - yoy_prior(column, partition, year)


def yoy_abs_by_source(df: DataFrame, column: str = "survey_adoption_pct") -> DataFrame:
    """Absolute change since the previous row of the same technology and source."""
    rows = df.where(F.col(column).isNotNull())
    keys = ["technology_name", "data_source"]
    return rows.withColumn("prior_year_pct", yoy_prior(column, keys)).withColumn(
        "yoy_change_abs", F.abs(F.col(column) - F.col("prior_year_pct"))
    )


def year_median(
    df: DataFrame, column: str, year: str, name: str
) -> DataFrame:
    """Median of `column`, whole units, per year.  An aggregate over counted values rather than a
    window: a year is a handful of partitions, and a window would pull all its rows into one task."""
    rows = df.where(F.col(column).isNotNull())
    counted = rows.groupBy(year, column).agg(F.count(F.lit(1)).alias("_n"))
    return weighted_percentiles(counted, [year], column, "_n", {name: 0.5})


def trailing_stats(
    df: DataFrame,
    column: str = "adoption_pct",
    partition: Sequence[str] = ("technology_name", "data_source"),
    year: str = "year",
    depth: int = 2,
) -> DataFrame:
    """Mean and sample deviation of the `depth` rows before each row, and the row's history."""
    ordered = Window.partitionBy(*partition).orderBy(year)
    before = ordered.rowsBetween(-depth, -1)
    history = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return df.select(
        "*",
        F.avg(column).over(before).alias("trailing_avg"),
        F.stddev(column).over(before).alias("trailing_stddev"),
        F.count(F.lit(1)).over(history).alias("prior_years_count"),
    )
