"""Spikes and drops in adoption."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.constants import (
    ANOMALY_HIGH_SIGMAS,
    ANOMALY_MIN_HISTORY,
    ANOMALY_SIGMAS,
    SURVEY_SOURCES,
)
from devpulse.functions import round_half_away
from devpulse.operators.aggregates import filter_sources
from devpulse.operators.windows import trailing_stats


def adoption_anomalies(adoption: DataFrame, ordered: bool = True) -> DataFrame:
    """Survey rates more than two trailing deviations away from their trailing mean."""
    rates = filter_sources(adoption, SURVEY_SOURCES, "survey_adoption_pct").select(
        "technology_name",
        "technology_category",
        "data_source",
        "year",
        F.col("survey_adoption_pct").alias("adoption_pct"),
    )
    mean, spread = F.col("trailing_avg"), F.col("trailing_stddev")
    deviation = F.col("adoption_pct") - mean
    flagged = trailing_stats(rates).where(
        (F.col("prior_years_count") >= ANOMALY_MIN_HISTORY)
        & (spread > 0)
        & (F.abs(deviation) > ANOMALY_SIGMAS * spread)
    )
    sigmas = F.abs(deviation / F.nullif(spread, F.lit(0.0)))
    result = flagged.select(
        "technology_name",
        "technology_category",
        "data_source",
        "year",
        round_half_away(F.col("adoption_pct"), 2).alias("adoption_pct"),
        round_half_away(mean, 2).alias("trailing_avg"),
        round_half_away(spread, 2).alias("trailing_stddev"),
        round_half_away(deviation, 2).alias("deviation"),
        round_half_away(deviation / F.nullif(spread, F.lit(0.0)), 2).alias("z_score"),
        F.when(deviation > 0, "spike").otherwise("drop").alias("anomaly_direction"),
        F.when(sigmas >= ANOMALY_HIGH_SIGMAS, "high")
        .when(sigmas >= ANOMALY_SIGMAS, "medium")
        .alias("severity"),
    )
    if not ordered:
        return result
    return result.orderBy(
        F.abs("z_score").desc_nulls_last(), F.desc("year"), F.asc("technology_name")
    )
