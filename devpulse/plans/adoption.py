"""Yearly adoption from surveys, and the fact that unifies all sources."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.constants import ACTIVITY, SURVEY_A, SURVEY_B
from devpulse.functions import pct_of_total
from devpulse.operators.aggregates import adoption_counts, respondent_totals
from devpulse.operators.joins import join_dim, join_spine, join_year_totals

ADOPTION_SCHEMA = {
    "year": "int",
    "technology_name": "string",
    "technology_category": "string",
    "data_source": "string",
    "survey_adoption_pct": "double",
    "survey_desire_pct": "double",
    "users_count": "long",
    "total_respondents": "long",
    "github_event_share": "double",
    "github_actor_share": "double",
    "github_total_events": "long",
    "github_unique_actors": "long",
    "github_unique_repos": "long",
}


def yearly_adoption(
    rows: DataFrame,
    surveys: DataFrame,
    spine: DataFrame,
    source: str,
    counts: Mapping[str, str],
    rates: Mapping[str, str],
    respondent: Sequence[str] = ("survey_response_id",),
) -> DataFrame:
    """Respondents per year and technology, and their share of all respondents of the year.

    `rows` may be the consolidated table or plain exploded answers: counting is per distinct
    respondent either way.  When `rows` is partitioned by `respondent`, the mapping join and
    the per-respondent step keep that partitioning and add no shuffle."""
    counted = adoption_counts(join_spine(rows, spine, "technology_name"), counts, respondent)
    totals = respondent_totals(surveys, respondent)
    total = F.col("total_respondents")
    return join_year_totals(counted, totals).select(
        "survey_year",
        "technology_name",
        "technology_category",
        "technology_subcategory",
        F.lit(source).alias("data_source"),
        *counts,
        total,
        *[pct_of_total(F.col(n), total).alias(rate) for rate, n in rates.items()],
    )


def adoption_a(
    rows: DataFrame,
    surveys: DataFrame,
    spine: DataFrame,
    respondent: Sequence[str] = ("survey_response_id",),
) -> DataFrame:
    """Yearly adoption and desire rates of survey A."""
    return yearly_adoption(
        rows,
        surveys,
        spine,
        SURVEY_A,
        {"users_count": "is_currently_used", "desired_count": "is_desired"},
        {"adoption_pct": "users_count", "desire_pct": "desired_count"},
        respondent,
    )


def adoption_b(
    rows: DataFrame,
    surveys: DataFrame,
    spine: DataFrame,
    respondent: Sequence[str] = ("survey_response_id",),
) -> DataFrame:
    """Yearly adoption rates of survey B."""
    return yearly_adoption(
        rows,
        surveys,
        spine,
        SURVEY_B,
        {"users_count": "is_currently_used"},
        {"adoption_pct": "users_count"},
        respondent,
    )


def align_typed_nulls(df: DataFrame, columns: Mapping[str, str] = ADOPTION_SCHEMA) -> DataFrame:
    """Project to `columns`, missing ones as NULLs of the right type."""
    have = set(df.columns)
    return df.selectExpr(
        *[f"CAST({c if c in have else 'NULL'} AS {t}) AS {c}" for c, t in columns.items()]
    )


def technology_adoption(
    survey_a: DataFrame, survey_b: DataFrame, activity: DataFrame, dim: DataFrame
) -> DataFrame:
    """One row per year, technology and source.

    The source label of each branch is a literal, so a consumer that filters on it makes
    Spark drop the other branches before they are computed."""
    surveyed = [
        df.withColumnsRenamed(
            {
                "survey_year": "year",
                "adoption_pct": "survey_adoption_pct",
                "desire_pct": "survey_desire_pct",
            }
        ).withColumn("data_source", F.lit(label))
        for df, label in ((survey_a, SURVEY_A), (survey_b, SURVEY_B))
    ]
    active = activity.withColumnsRenamed(
        {
            "activity_year": "year",
            "event_share": "github_event_share",
            "actor_share": "github_actor_share",
            "total_events": "github_total_events",
            "total_unique_actors": "github_unique_actors",
            "total_unique_repos": "github_unique_repos",
        }
    ).withColumn("data_source", F.lit(ACTIVITY))
    unified = (
        align_typed_nulls(surveyed[0])
        .unionByName(align_typed_nulls(surveyed[1]))
        .unionByName(align_typed_nulls(active))
    )
    return join_dim(unified, dim, ["technology_id"]).select(*ADOPTION_SCHEMA, "technology_id")
