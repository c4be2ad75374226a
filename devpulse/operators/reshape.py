"""Lists to rows, and rows to years."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.constants import LIST_SEPARATOR
from devpulse.functions import round_half_away, split_text

RESPONDENT = ("survey_response_id", "survey_year")


@dataclass(frozen=True)
class AnswerList:
    """A multi-select column and what naming a technology in it says about the respondent."""

    column: str
    category: str
    flags: Mapping[str, bool] = field(default_factory=dict)


def _used(column: str, category: str) -> AnswerList:
    return AnswerList(column, category, {"is_currently_used": True, "is_desired": False})


def _desired(column: str, category: str) -> AnswerList:
    return AnswerList(column, category, {"is_currently_used": False, "is_desired": True})


SURVEY_A_LISTS = [
    _used("languages_used", "language"),
    _desired("languages_desired", "language"),
    _used("databases_used", "database"),
    _desired("databases_desired", "database"),
    _used("web_frameworks_used", "web_framework"),
    _desired("web_frameworks_desired", "web_framework"),
    _used("platforms_used", "platform"),
    _desired("platforms_desired", "platform"),
]
SURVEY_B_LISTS = [
    AnswerList("languages_used", "language", {"is_currently_used": True, "may_be_primary": True}),
    AnswerList(
        "languages_plan_to_adopt",
        "language",
        {"is_currently_used": False, "may_be_primary": False},
    ),
    AnswerList(
        "frameworks_used", "framework", {"is_currently_used": True, "may_be_primary": False}
    ),
]


def explode_multiselect(
    df: DataFrame,
    column: str,
    separator: str = LIST_SEPARATOR,
    name: str = "technology_name",
    keep_blank: bool = False,
) -> DataFrame:
    """One row per answer in a delimited list, trimmed; NULL lists give no row and blank parts
    are dropped unless `keep_blank`."""
    rows = df.select("*", F.explode(split_text(F.col(column), separator)).alias(name))
    rows = rows.withColumn(name, F.trim(name))
    return rows if keep_blank else rows.where(F.col(name) != "")


def explode_answer_lists(
    surveys: DataFrame, lists: Sequence[AnswerList], carry: Sequence[str] = RESPONDENT
) -> DataFrame:
    """One row per answer of every list, with category and flags.

    The surveys are read once: each row is widened to an array of its lists, and that array
    and then the list texts are exploded in place.  There is no shuffle, and rows keep the
    partitioning of their respondent."""
    tagged = [
        ", ".join(
            [f"'{a.category}' AS technology_category"]
            + [f"{value} AS {flag}" for flag, value in a.flags.items()]
            + [f"{a.column} AS answers"]
        )
        for a in lists
    ]
    widened = F.expr(f"inline(array({', '.join(f'struct({t})' for t in tagged)}))")
    rows = surveys.select(*carry, widened).where(F.col("answers").isNotNull())
    return explode_multiselect(rows, "answers").drop("answers")


def or_flags(rows: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """One row per key; a flag is set when any of the key's rows sets it."""
    return rows.groupBy(*keys).agg(*[F.bool_or(f).alias(f) for f in flags])


def technology_rows_a(surveys: DataFrame, carry: Sequence[str] = RESPONDENT) -> DataFrame:
    return explode_answer_lists(surveys, SURVEY_A_LISTS, carry)


def technology_rows_b(surveys: DataFrame, carry: Sequence[str] = RESPONDENT) -> DataFrame:
    carried = [*carry, "primary_language"]
    rows = explode_answer_lists(surveys, SURVEY_B_LISTS, carried)
    is_primary = F.col("may_be_primary") & F.coalesce(
        F.col("primary_language") == F.col("technology_name"), F.lit(False)
    )
    return rows.withColumn("is_primary", is_primary).drop("primary_language", "may_be_primary")


def unpivot_survey_a(surveys: DataFrame, respondent: Sequence[str] = RESPONDENT) -> DataFrame:
    """One row per respondent, technology and category, flagged used and/or desired."""
    keys = [*respondent, "technology_name", "technology_category"]
    return or_flags(
        technology_rows_a(surveys, respondent), keys, ["is_currently_used", "is_desired"]
    )


def unpivot_survey_b(surveys: DataFrame, respondent: Sequence[str] = RESPONDENT) -> DataFrame:
    """One row per respondent, technology and category, flagged used and/or primary."""
    keys = [*respondent, "technology_name", "technology_category"]
    return or_flags(
        technology_rows_b(surveys, respondent), keys, ["is_currently_used", "is_primary"]
    )


def pivot_years(
    df: DataFrame,
    years: Sequence[int],
    value: str,
    row: str = "technology_name",
    year: str = "year",
) -> DataFrame:
    """Mean of `value` per row and year, one column per year, one digit."""
    wide = df.groupBy(row).pivot(year, list(years)).agg(F.avg(value))
    return wide.select(
        row, *[round_half_away(F.col(f"`{y}`"), 1).alias(f"y{y}") for y in years]
    )
