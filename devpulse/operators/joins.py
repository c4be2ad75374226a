"""Joins.

None of them carries a broadcast hint.  Spark broadcasts a side when its own size estimate, or
under adaptive execution its measured size, is below `spark.sql.autoBroadcastJoinThreshold`;
past that it falls back to a sort-merge join whose hot partitions adaptive execution splits.
The mapping seed is a local relation of exactly known size, so with it the big side is not
shuffled at all.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPINE_COLUMNS = ["technology_name", "technology_category", "technology_subcategory"]


def join_spine(df: DataFrame, spine: DataFrame, on: str) -> DataFrame:
    """Replace the source name in `on` by the canonical name, category and subcategory; rows
    with an unmapped name are dropped.  The source's own category is not part of the key and
    gives way to the mapping's."""
    mapping = spine.select(
        F.col("source_name").alias("_source_name"),
        F.col("canonical_name").alias("_canonical"),
        F.col("technology_category").alias("_category"),
        F.col("technology_subcategory").alias("_subcategory"),
    )
    kept = [c for c in df.columns if c not in (on, *SPINE_COLUMNS)]
    return df.join(mapping, df[on] == mapping["_source_name"], "inner").select(
        *kept,
        F.col("_canonical").alias("technology_name"),
        F.col("_category").alias("technology_category"),
        F.col("_subcategory").alias("technology_subcategory"),
    )


def join_year_totals(df: DataFrame, totals: DataFrame, year: str = "survey_year") -> DataFrame:
    return df.join(totals, year, "inner")


def join_respondent(
    surveys: DataFrame, technologies: DataFrame, respondent: Sequence[str] = ("survey_response_id",)
) -> DataFrame:
    """Survey answers next to each technology of the respondent."""
    kept = [c for c in technologies.columns if c in respondent or c not in surveys.columns]
    return surveys.join(technologies.select(*kept), list(respondent), "inner")


def join_dim(df: DataFrame, dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add dimension columns by technology name; names the dimension lacks keep NULLs."""
    return df.join(dim.select("technology_name", *columns), "technology_name", "left")


def join_presence(names: DataFrame, sources: dict[str, DataFrame], on: str) -> DataFrame:
    """A flag per source telling whether it knows the name in `on`.

    The sources are tagged, stacked and grouped by name once, so one join serves all of them
    and a name that repeats within a source cannot fan out."""
    stacked = None
    for flag, df in sources.items():
        tagged = df.select(F.col("technology_name").alias("_known"), F.lit(flag).alias("_flag"))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    known = stacked.groupBy("_known").agg(
        *[F.bool_or(F.col("_flag") == flag).alias(flag) for flag in sources]
    )
    return names.join(known, names[on] == known["_known"], "left").select(
        *names.columns, *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in sources]
    )


def presence_flags(df: DataFrame, columns: dict[str, str], total: str) -> DataFrame:
    """NOT NULL flags for `columns` (column -> flag) and their sum."""
    flags = {flag: F.col(c).isNotNull() for c, flag in columns.items()}
    return df.select(
        "*",
        *[test.alias(flag) for flag, test in flags.items()],
        count_true(*flags.values()).alias(total),
    )


def count_true(*flags: Column) -> Column:
    total = F.lit(0)
    for flag in flags:
        total = total + flag.cast("int")
    return total


def full_outer_compare(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both sides matched on `keys`; keys come from whichever side has them.  Meant for
    sides with one row per key, such as two aggregates."""
    return left.join(right, list(keys), "full")


def cross_expected(df: DataFrame, column: str, values: Sequence[str], name: str) -> DataFrame:
    """Every value of `column` paired with each of a fixed list; an explode, not a cross join."""
    literals = F.array(*[F.lit(v) for v in values])
    return df.select(column).distinct().select(column, F.explode(literals).alias(name))


def anti_missing(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected rows that `actual` lacks."""
    return expected.join(actual.select(*keys), list(keys), "left_anti")


def latest_year_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows at the largest value of `column`, found by a scalar subquery."""
    latest = df.select(F.max(column)).scalar()
    return df.where(F.col(column) == latest)


def keep_top(df: DataFrame, top: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are in `top`."""
    return df.join(top.select(*keys), list(keys), "left_semi")
