"""Pay by technology stack."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.constants import LIST_SEPARATOR, PAY_FREQUENCY, PAY_HIGH, PAY_LOW
from devpulse.functions import round_half_away, split_text
from devpulse.operators.aggregates import salary_stats
from devpulse.operators.joins import join_dim, join_respondent, join_spine
from devpulse.operators.reshape import SURVEY_A_LISTS
from devpulse.operators.windows import year_median
from devpulse.sources.sinks import cut_lineage

SALARY_KEYS = [
    "survey_year",
    "technology_name",
    "technology_category",
    "technology_subcategory",
    "country",
    "developer_roles",
    "years_coding_professional",
    "education_level",
]
RESPONDENT_TRAITS = [
    "survey_year",
    "country",
    "developer_roles",
    "years_coding_professional",
    "education_level",
    "compensation_total",
]


def filter_valid_salary(
    df: DataFrame,
    low: int = PAY_LOW,
    high: int = PAY_HIGH,
    frequency: str = PAY_FREQUENCY,
    pay: str = "compensation_total",
    period: str = "compensation_frequency",
) -> DataFrame:
    """Rows with yearly pay between the two limits, both included."""
    amount = F.col(pay)
    return df.where(
        amount.isNotNull()
        & (amount > 0)
        & (F.col(period) == frequency)
        & amount.between(low, high)
    )


def filter_used(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_currently_used"))


NATURAL_KEY = ("response_id", "survey_year")


def paid_technologies(surveys: DataFrame, technologies: DataFrame) -> DataFrame:
    """Each validly paid respondent next to each technology they use.  Where both sides have the
    short natural key they meet on it, and the hashed one is not shuffled."""
    natural = all(set(NATURAL_KEY) <= set(df.columns) for df in (surveys, technologies))
    key = list(NATURAL_KEY) if natural else ["survey_response_id"]
    paid = filter_valid_salary(surveys).select(*dict.fromkeys(["survey_response_id", *key, *RESPONDENT_TRAITS]))
    used = filter_used(technologies).select(*key, "technology_name")
    return join_respondent(paid, used, key)


def paid_technologies_in_place(surveys: DataFrame) -> DataFrame:
    """`paid_technologies` straight from the surveys, for surveys with one row per respondent.

    The row's own lists are exploded, each answer once per list, so neither the consolidation
    of answers nor the join back to the respondent is needed and nothing is shuffled."""
    used = [a.column for a in SURVEY_A_LISTS if a.flags["is_currently_used"]]
    carried = ["survey_response_id", *RESPONDENT_TRAITS]
    answers = F.flatten(F.array(*[distinct_answers(F.col(c)) for c in used]))
    rows = filter_valid_salary(surveys).select(
        *carried, F.explode(answers).alias("technology_name")
    )
    return rows.where(F.col("technology_name") != "")


def distinct_answers(text: Column) -> Column:
    """The answers of a list, trimmed, each once; an empty array for NULL."""
    trimmed = F.transform(split_text(text, LIST_SEPARATOR), lambda answer: F.trim(answer))
    return F.coalesce(F.array_distinct(trimmed), F.array().cast("array<string>"))


def salary_by_stack(
    surveys: DataFrame,
    technologies: DataFrame | None,
    spine: DataFrame,
    dim: DataFrame,
    dedupe: bool = False,
    keys: Sequence[str] = SALARY_KEYS,
) -> DataFrame:
    """Pay statistics per stack, and the premium over the year's median of group medians.

    `technologies=None` says that `surveys` has one row per respondent, which allows the plan
    without respondent shuffles.  A respondent who lists two names of one technology counts
    once per name; `dedupe` counts them once."""
    if technologies is None:
        people = paid_technologies_in_place(surveys)
    else:
        people = paid_technologies(surveys, technologies)
    mapped = join_spine(people, spine, "technology_name")
    if dedupe:
        mapped = mapped.select("survey_response_id", *keys, "compensation_total").distinct()
    groups = cut_lineage(salary_stats(mapped, keys))
    medians = year_median(groups, "median_salary", "survey_year", "global_median_salary")
    middle = F.col("global_median_salary")
    premium = (F.col("median_salary") - middle) * 100.0 / F.nullif(middle, F.lit(0.0))
    rated = groups.join(medians, "survey_year", "left").withColumn(
        "salary_premium_pct", round_half_away(premium, 2)
    )
    return join_dim(rated, dim, ["technology_id"]).select(
        *groups.columns, "technology_id", "global_median_salary", "salary_premium_pct"
    )
