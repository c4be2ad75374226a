"""Name resolution."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devpulse.constants import NAME_MAPPING
from devpulse.functions import surrogate_key
from devpulse.operators.windows import dedup_mapping

SEED_COLUMNS = [
    "source_name",
    "canonical_name",
    "technology_category",
    "technology_subcategory",
]


def mapping_seed(spark: SparkSession) -> DataFrame:
    """The fixed mapping as inline values: a local relation, whose size Spark knows before it
    plans the joins, so it is broadcast without a hint and without a shuffle of the big side."""
    rows = ", ".join(
        "(" + ", ".join("'" + text.replace("'", "\\'") + "'" for text in row) + ")"
        for row in NAME_MAPPING
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS seed({', '.join(SEED_COLUMNS)})")


def technology_spine(seed: DataFrame) -> DataFrame:
    """One row per source name with its canonical technology and id."""
    return dedup_mapping(seed).select(
        surrogate_key("canonical_name", "technology_category").alias("technology_id"),
        "source_name",
        "canonical_name",
        "technology_category",
        "technology_subcategory",
    )


def technologies(spine: DataFrame) -> DataFrame:
    """Distinct canonical technologies: the dimension without its presence flags.

    Facts that only need ids and subcategories join this instead of the full dimension, so
    they do not repeat the yearly tables behind the flags."""
    return spine.select(
        "technology_id",
        F.col("canonical_name").alias("technology_name"),
        "technology_category",
        "technology_subcategory",
    ).distinct()
