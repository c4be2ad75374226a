"""Report queries over the facts.  Filters, grouping and ranking all run in Spark; a report is
the final top-k."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devpulse.constants import SURVEY_SOURCES
from devpulse.functions import clamp, ordered_text, round_half_away
from devpulse.operators.aggregates import filter_sources, mean_over_sources, top_n_by_mean
from devpulse.operators.joins import keep_top, latest_year_rows
from devpulse.operators.ordering import first_last, order_by_abs, top_k
from devpulse.operators.roles import label_roles, skill_shares, top_per

RATE = "survey_adoption_pct"


# --- adoption ---------------------------------------------------------------


def adoption_series(
    adoption: DataFrame,
    category: str | None = None,
    source: str | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Survey rates per year and technology, of one source or averaged over both."""
    rows = filter_sources(adoption, [source] if source else SURVEY_SOURCES, RATE)
    if years is not None:
        rows = rows.where(F.col("year").between(*years))
    if category is not None:
        rows = rows.where(F.col("technology_category") == category)
    rows = rows.select("year", "technology_name", "technology_category", RATE)
    return rows if source else mean_over_sources(rows)


def adoption_trend(
    adoption: DataFrame,
    category: str | None = None,
    source: str | None = None,
    n: int = 15,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Series of the `n` technologies with the largest mean rate."""
    series = adoption_series(adoption, category, source, years)
    return keep_top(series, top_n_by_mean(series, n), ["technology_name"])


def adoption_headline(trend: DataFrame) -> DataFrame:
    """Top technology of the latest year, its rate, change on the year before, and how many
    technologies are shown."""
    rates = trend.groupBy("year", "technology_name").agg(F.avg(RATE).alias("pct"))
    history = Window.partitionBy("technology_name").orderBy("year")
    follows = F.lag("year").over(history) == F.col("year") - 1
    rates = rates.withColumn("before", F.when(follows, F.lag("pct").over(history)))
    # smallest of (-year, -pct, name): latest year, then highest rate, then first name
    place = F.struct(
        (-F.col("year")).alias("y"), (-F.col("pct")).alias("p"), "technology_name", "before"
    )
    best = rates.agg(
        F.min(place).alias("b"), F.count_distinct("technology_name").alias("technologies_shown")
    )
    return best.select(
        (-F.col("b.y")).alias("latest_year"),
        F.col("b.technology_name").alias("top_technology"),
        (-F.col("b.p")).alias("top_pct"),
        round_half_away(-F.col("b.p") - F.col("b.before"), 1).alias("yoy_delta"),
        "technologies_shown",
    )


def adoption_context(trend: DataFrame, n: int = 10) -> DataFrame:
    """One line of text per technology: its yearly rates, for the `n` largest."""
    rates = trend.groupBy("year", "technology_name").agg(F.avg(RATE).alias("pct"))
    point = F.concat(
        F.col("year").cast("string"),
        F.lit(": "),
        F.format_string("%.1f%%", round_half_away(F.col("pct"), 1)),
    )
    lines = rates.groupBy("technology_name").agg(ordered_text(F.col("year"), point).alias("trend"))
    return (
        top_n_by_mean(trend, n)
        .join(lines, "technology_name", "inner")
        .select(
            "technology_name",
            F.concat("technology_name", F.lit(": "), "trend").alias("context_line"),
        )
    )


# --- said versus did ---------------------------------------------------------


def said_vs_did_report(facts: DataFrame, year: int | None = None, n: int = 25) -> DataFrame:
    """The `n` largest gaps of a year (the latest by default) among surveyed technologies;
    missing activity shows as zero."""
    surveyed = facts.where(F.col("avg_survey_adoption_pct").isNotNull())
    known = facts.where(
        F.col("avg_survey_adoption_pct").isNotNull() | F.col("github_activity_pct").isNotNull()
    )
    wanted = F.lit(year) if year is not None else known.select(F.max("year")).scalar()
    rows = surveyed.where(F.col("year") == wanted).select(
        "year",
        "technology_name",
        "technology_category",
        "avg_survey_adoption_pct",
        F.coalesce(F.col("github_activity_pct"), F.lit(0.0)).alias("github_activity_pct"),
        "said_vs_did_gap",
        "said_vs_did_classification",
    )
    return top_k(
        rows, [F.desc_nulls_last("said_vs_did_gap"), F.asc("technology_name")], n
    )


def said_vs_did_summary(report: DataFrame) -> DataFrame:
    """How many technologies of a report fall into each class, and the largest gap."""
    label = F.col("said_vs_did_classification")
    place = F.struct((-F.col("said_vs_did_gap")).alias("g"), F.col("technology_name").alias("t"))
    widest = F.min(F.when(F.col("said_vs_did_gap").isNotNull(), place))
    return report.agg(
        F.count_if(label == "over_reported").alias("over_reported"),
        F.count_if(label == "under_reported").alias("under_reported"),
        F.count_if(label == "consistent").alias("consistent"),
        widest["t"].alias("widest_technology"),
        (-widest["g"]).alias("widest_gap"),
    )


# --- pay ---------------------------------------------------------------------


def meaningful_pay(salary: DataFrame, min_respondents: int = 10) -> DataFrame:
    return salary.where(
        F.col("median_salary").isNotNull() & (F.col("respondent_count") >= min_respondents)
    )


def country_totals(
    salary: DataFrame, year: int, n: int = 30, min_respondents: int = 10
) -> DataFrame:
    """The `n` countries with most respondents in a year."""
    totals = (
        meaningful_pay(salary, min_respondents)
        .where((F.col("survey_year") == year) & F.col("country").isNotNull())
        .groupBy("country")
        .agg(F.sum("respondent_count").alias("respondents"))
    )
    return top_k(totals, [F.desc("respondents"), F.asc("country")], n)


def salary_rollup(rows: DataFrame) -> DataFrame:
    """Medians, means and respondents per technology over the remaining groups.

    The figures are whole pay amounts inside the valid range, so the count map behind each
    median is bounded however many groups a technology has."""
    return rows.groupBy("technology_name", "technology_category").agg(
        F.median("median_salary").alias("median_salary"),
        F.median("p25_salary").alias("p25_salary"),
        F.median("p75_salary").alias("p75_salary"),
        F.avg("salary_premium_pct").alias("salary_premium_pct"),
        F.sum("respondent_count").alias("respondent_count"),
        F.avg("global_median_salary").alias("global_median_salary"),
    )


def salary_report(
    salary: DataFrame,
    year: int,
    country: str | None = None,
    experience: int | None = None,
    n: int = 20,
    min_respondents: int = 10,
) -> DataFrame:
    """Best-paid technologies of a year with quartile arms and a confidence between 0.4 and 1."""
    rows = meaningful_pay(salary, min_respondents).where(F.col("survey_year") == year)
    if country is not None:
        rows = rows.where(F.col("country") == country)
    if experience is not None:
        rows = rows.where(F.col("years_coding_professional") == experience)
    best = top_k(
        salary_rollup(rows), [F.desc_nulls_last("median_salary"), F.asc("technology_name")], n
    )
    # the window covers the n rows of the report
    most = F.max("respondent_count").over(Window.partitionBy(F.lit(0)))
    return best.select(
        "*",
        F.greatest(F.col("p75_salary") - F.col("median_salary"), F.lit(0.0)).alias("arm_above"),
        F.greatest(F.col("median_salary") - F.col("p25_salary"), F.lit(0.0)).alias("arm_below"),
        clamp(F.col("respondent_count") / most, 0.4, 1.0).alias("confidence"),
    )


def salary_summary(report: DataFrame) -> DataFrame:
    """Global median, best and worst paid technology of a report, and its length."""
    ends = first_last(report, "median_salary", "technology_name")
    totals = report.agg(
        F.avg("global_median_salary").alias("global_median_salary"),
        F.count(F.lit(1)).alias("technologies_shown"),
    )
    return ends.select(
        "*",
        totals.select("global_median_salary").scalar().alias("global_median_salary"),
        totals.select("technologies_shown").scalar().alias("technologies_shown"),
    )


# --- roles and skills ---------------------------------------------------------

def _most_listed() -> list[Column]:
    return [F.desc("skill_count"), F.asc("skill")]


def role_skills(surveys: DataFrame, role: str, column: str, n: int = 15) -> DataFrame:
    """Most listed skills of a role."""
    labelled = label_roles(surveys).where(F.col("role") == role)
    return top_k(skill_shares(labelled, column, ["role"]), _most_listed(), n)


def role_skills_compare(surveys: DataFrame, column: str, n: int | None = 12) -> DataFrame:
    """Most listed skills of every role, in one grouped query; all skills without `n`."""
    shares = skill_shares(label_roles(surveys), column, ["role"])
    return shares if n is None else top_per(shares, ["role"], _most_listed(), n)


def role_skills_trend(
    surveys: DataFrame,
    role: str,
    column: str,
    year: int,
    n: int = 10,
    year_column: str = "survey_year",
) -> DataFrame:
    """Each year's top skills of a role, kept if they are in the top of `year`."""
    labelled = label_roles(surveys).where(F.col("role") == role)
    yearly = top_per(
        skill_shares(labelled, column, [year_column]), [year_column], _most_listed(), n
    )
    current = yearly.where(F.col(year_column) == year)
    return keep_top(yearly, current, ["skill"])


def skills_text(skills: DataFrame) -> DataFrame:
    """One line per role: its skills with percentages, most listed first."""
    item = F.concat("skill", F.lit(" ("), F.col("pct").cast("string"), F.lit("%)"))
    order = F.struct((-F.col("skill_count")).alias("c"), F.col("skill").alias("s"))
    return skills.groupBy("role").agg(ordered_text(order, item).alias("skill_summary"))


# --- extracts for a written report --------------------------------------------


def top_gaps(facts: DataFrame, first_year: int = 2022, n: int = 30) -> DataFrame:
    """Largest gaps of either sign; gaps that cannot be computed come first, as published."""
    rows = facts.where(F.col("year") >= first_year).select(
        "year",
        "technology_name",
        "technology_category",
        "avg_survey_adoption_pct",
        "github_activity_pct",
        "said_vs_did_gap",
        "said_vs_did_classification",
    )
    tie = [F.asc("year"), F.asc("technology_name")]
    return order_by_abs(rows, "said_vs_did_gap", tie, nulls_first=True).limit(n)


def latest_sentiment(sentiment: DataFrame, n: int = 25) -> DataFrame:
    """Largest desire gaps of the latest year."""
    rows = latest_year_rows(sentiment, "year").select(
        "year",
        "technology_name",
        "technology_category",
        "adoption_pct",
        "desire_pct",
        "desire_gap",
        "adoption_yoy_change",
        "lifecycle_stage",
    )
    return top_k(rows, [F.desc_nulls_first("desire_gap"), F.asc("technology_name")], n)


def salary_premiums(
    salary: DataFrame, country: str, min_respondents: int = 50, n: int = 20
) -> DataFrame:
    """Best premiums of a country in the latest year, for well-covered technologies."""
    totals = (
        latest_year_rows(salary, "survey_year")
        .where(F.col("country") == country)
        .groupBy("technology_name", "technology_category")
        .agg(
            F.avg("median_salary").alias("avg_median_salary"),
            F.avg("salary_premium_pct").alias("avg_premium_pct"),
            F.sum("respondent_count").alias("total_respondents"),
        )
        .where(F.col("total_respondents") >= min_respondents)
    )
    return top_k(totals, [F.desc_nulls_first("avg_premium_pct"), F.asc("technology_name")], n)


def emerging_declining(
    sentiment: DataFrame, stages: Sequence[str] = ("emerging", "declining")
) -> DataFrame:
    """Technologies of the latest year in one of two stages."""
    return (
        latest_year_rows(sentiment, "year")
        .where(F.col("lifecycle_stage").isin(list(stages)))
        .select("technology_name", "lifecycle_stage", "adoption_pct", "desire_pct", "desire_gap")
        .orderBy("lifecycle_stage", F.desc_nulls_first("desire_gap"), "technology_name")
    )
