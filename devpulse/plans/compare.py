"""Said versus did."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.constants import ACTIVITY, GAP_FACTOR, SURVEY_SOURCES
from devpulse.functions import round_half_away
from devpulse.operators.aggregates import filter_sources, survey_average
from devpulse.operators.joins import full_outer_compare, join_dim


def classify_gap(said: Column, did: Column) -> Column:
    """A technology without activity counts as zero activity; one without a survey rate
    cannot be judged and is `consistent`."""
    did = F.coalesce(did, F.lit(0.0))
    return (
        F.when(said > did * GAP_FACTOR, "over_reported")
        .when(did > said * GAP_FACTOR, "under_reported")
        .otherwise("consistent")
    )


def said_vs_did(adoption: DataFrame, dim: DataFrame) -> DataFrame:
    """Survey rates against activity shares per year and technology."""
    said = survey_average(adoption, SURVEY_SOURCES)
    did = filter_sources(adoption, [ACTIVITY]).select(
        "year",
        "technology_name",
        (F.col("github_event_share") * 100).alias("github_activity_pct"),
        (F.col("github_actor_share") * 100).alias("github_actor_pct"),
        "github_total_events",
        "github_unique_actors",
    )
    rate, share = F.col("avg_survey_adoption_pct"), F.col("github_activity_pct")
    compared = full_outer_compare(said, did, ["year", "technology_name"]).select(
        "year",
        "technology_name",
        "technology_category",
        "avg_survey_adoption_pct",
        "max_survey_desire_pct",
        "github_activity_pct",
        "github_actor_pct",
        "github_total_events",
        "github_unique_actors",
        round_half_away(rate - F.coalesce(share, F.lit(0.0)), 2).alias("said_vs_did_gap"),
        classify_gap(rate, share).alias("said_vs_did_classification"),
    )
    extra = ["technology_id", "technology_subcategory"]
    return join_dim(compared, dim, extra).select(*compared.columns, *extra)
