"""Yearly activity."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.constants import ACTIVITY
from devpulse.operators.joins import join_spine
from devpulse.operators.windows import share_of_year

SUMS = {
    "total_events": "event_count",
    "total_unique_actors": "unique_actors",
    "total_unique_repos": "unique_repos",
    "total_commits": "total_commits",
    "total_additions": "total_additions",
    "total_deletions": "total_deletions",
}


def yearly_activity(monthly: DataFrame, spine: DataFrame) -> DataFrame:
    """Sums per year and mapped technology, and the plain mean of the monthly star means.

    Yearly actors and repositories are sums of monthly distinct counts, as published."""
    mapped = join_spine(monthly, spine, "repo_language").withColumn(
        "_year", F.year("activity_month")
    )
    return mapped.groupBy(
        F.col("_year").alias("activity_year"),
        "technology_name",
        "technology_category",
        "technology_subcategory",
    ).agg(
        *[F.sum(c).cast("long").alias(name) for name, c in SUMS.items()],
        F.avg("avg_repo_stars").alias("avg_stars"),
    )


def activity_yearly(monthly: DataFrame, spine: DataFrame) -> DataFrame:
    """Yearly activity with each technology's share of the mapped events and actors."""
    yearly = yearly_activity(monthly, spine)
    shares = {"event_share": "total_events", "actor_share": "total_unique_actors"}
    return share_of_year(yearly, shares, "activity_year").select(
        "activity_year",
        "technology_name",
        "technology_category",
        "technology_subcategory",
        F.lit(ACTIVITY).alias("data_source"),
        *SUMS,
        "avg_stars",
        *shares,
    )
