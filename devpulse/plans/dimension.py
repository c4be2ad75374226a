"""Technology dimension."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.operators.joins import count_true, join_presence
from devpulse.plans.spine import technologies


def dim_technologies(
    spine: DataFrame, survey_a: DataFrame, survey_b: DataFrame, activity: DataFrame
) -> DataFrame:
    """One row per canonical technology, with the sources that know it."""
    sources = {
        "in_stackoverflow": survey_a,
        "in_jetbrains": survey_b,
        "in_github": activity,
    }
    known = join_presence(technologies(spine), sources, "technology_name")
    return known.withColumn("source_coverage_count", count_true(*[F.col(c) for c in sources]))
