"""Roles and skills."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devpulse.constants import LIST_SEPARATOR, ROLE_ALIASES
from devpulse.functions import contains_any, round_half_away, split_text
from devpulse.functions.scalars import WHITESPACE
from devpulse.operators.reshape import explode_multiselect
from devpulse.sources.sinks import cut_lineage


def label_roles(
    df: DataFrame, aliases: Mapping[str, Sequence[str]] = ROLE_ALIASES, column: str = "dev_type"
) -> DataFrame:
    """One row per respondent and matching role.

    The roles are a short fixed list, so each row tests them in place and explodes the ones
    that match; a pattern join would compare every row with every role in a nested loop."""
    matches = [F.when(contains_any(F.col(column), names), role) for role, names in aliases.items()]
    return df.select("*", F.explode(F.array_compact(F.array(*matches))).alias("role"))


def role_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("role").agg(F.count(F.lit(1)).alias("respondents"))


def explode_skills(df: DataFrame, column: str) -> DataFrame:
    """One row per listed skill without white space around it; blank parts stay, as the counts
    include them."""
    rows = explode_multiselect(df, column, name="skill", keep_blank=True)
    return rows.withColumn("skill", F.btrim("skill", F.lit(WHITESPACE)))


def skill_shares(labelled: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """How often each skill is listed within a key, and as a percentage of the key's rows that
    answered the question at all."""
    answered = labelled.where(F.col(column).isNotNull()).select(*keys, column)
    skills = F.transform(
        split_text(F.col(column), LIST_SEPARATOR), lambda skill: F.btrim(skill, F.lit(WHITESPACE))
    )
    # a NULL besides the skills counts the answer itself, so one pass gives both counts
    listed = F.explode(F.concat(F.array(F.lit(None).cast("string")), skills)).alias("skill")
    counted = cut_lineage(
        answered.select(*keys, listed).groupBy(*keys, "skill").agg(F.count(F.lit(1)).alias("skill_count"))
    )
    totals = counted.where("skill IS NULL").select(*keys, F.col("skill_count").alias("answered"))
    counts = counted.where("skill IS NOT NULL")
    pct = round_half_away(F.col("skill_count") / F.col("answered") * 100, 1)
    return counts.join(totals, list(keys), "inner").select(
        *keys, "skill", "skill_count", pct.alias("pct")
    )


def top_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First `n` rows of each key.  Spark applies the limit inside every task before the
    shuffle, so a key's final task sees at most `n` rows per task."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")
