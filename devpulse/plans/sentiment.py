"""Desire against use, and the lifecycle stage it implies."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.functions import round_half_away
from devpulse.operators.joins import join_dim
from devpulse.operators.windows import yoy_delta


def lifecycle_stage(
    adoption: Column, desire: Column, d_adoption: Column, d_desire: Column
) -> Column:
    """The first year of a technology has no change and so is never emerging or declining."""
    wanted, settled = desire > adoption, adoption > desire
    return (
        F.when(wanted & (d_desire > 0), "emerging")
        .when(wanted, "growing_interest")
        .when(settled & (d_adoption < 0), "declining")
        .when(settled, "established_but_waning")
        .otherwise("stable")
    )


def technology_sentiment(survey_a: DataFrame, dim: DataFrame) -> DataFrame:
    """Desire gap, yearly changes and lifecycle stage per year and technology of survey A."""
    rated = survey_a.where(F.col("desire_pct").isNotNull()).select(
        F.col("survey_year").alias("year"),
        "technology_name",
        "technology_category",
        "adoption_pct",
        "desire_pct",
        F.col("users_count").alias("current_users"),
        F.col("desired_count").alias("aspiring_users"),
        "total_respondents",
    )
    moved = rated.select(
        "*",
        round_half_away(F.col("desire_pct") - F.col("adoption_pct"), 2).alias("desire_gap"),
        yoy_delta("adoption_pct").alias("adoption_yoy_change"),
        yoy_delta("desire_pct").alias("desire_yoy_change"),
    )
    staged = moved.withColumn(
        "lifecycle_stage",
        lifecycle_stage(
            F.col("adoption_pct"),
            F.col("desire_pct"),
            F.col("adoption_yoy_change"),
            F.col("desire_yoy_change"),
        ),
    )
    extra = ["technology_id", "technology_subcategory"]
    return join_dim(staged, dim, extra).select(*staged.columns, *extra)
