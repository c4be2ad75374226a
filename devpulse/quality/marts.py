"""Checks of the fact tables, and the declared checks of every table."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from devpulse.constants import (
    ALL_SOURCES,
    GAP_CLASSES,
    LIFECYCLE_STAGES,
    SURVEY_YEARS,
    TECHNOLOGY_CATEGORIES,
    UNPIVOTED_CATEGORIES,
)
from devpulse.functions import round_half_away
from devpulse.operators.joins import anti_missing, cross_expected
from devpulse.operators.windows import yoy_abs_by_source
from devpulse.quality.checks import (
    check_accepted_range,
    check_accepted_values,
    check_not_null,
    check_unique,
    check_unique_combination,
    failing,
)
from devpulse.sources.sinks import write_full_refresh

FAILURE = ["technology_name", "year", "failure_reason"]


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return check_unique_combination(df, keys).withColumn(
        "failure_reason", F.lit("duplicate_primary_key")
    )


def _named(df: DataFrame, columns: Sequence[str] = FAILURE) -> DataFrame:
    return df.withColumn("year", F.col("year").cast("string")).select(*columns)


def check_adoption_mart(
    df: DataFrame, sources: Sequence[str] = ALL_SOURCES, max_change: float = 50
) -> DataFrame:
    """Repeated keys, jumps of more than 50 points in a year, sources missing from a year."""
    columns = ["technology_name", "year", "data_source", "failure_reason"]
    jumps = (
        yoy_abs_by_source(df)
        .where(F.col("yoy_change_abs") > max_change)
        .withColumn(
            "failure_reason",
            _text(
                "yoy_adoption_change_over_50ppt (",
                round_half_away(F.col("yoy_change_abs"), 1),
                " ppt)",
            ),
        )
    )
    pairs = df.select("year", "data_source").distinct()
    missing = (
        anti_missing(cross_expected(df, "year", sources, "data_source"), pairs, pairs.columns)
        .withColumn("technology_name", F.lit(None).cast("string"))
        .withColumn("failure_reason", F.lit("missing_data_source_for_year"))
    )
    repeated = _duplicates(df, ["technology_name", "year", "data_source"])
    return (
        _named(repeated, columns)
        .unionByName(_named(jumps, columns))
        .unionByName(_named(missing, columns))
    )


def check_said_vs_did_mart(df: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Repeated keys, wrong gaps, classes against the sign of the gap, rows without data."""
    said, did = F.col("avg_survey_adoption_pct"), F.col("github_activity_pct")
    gap, label = F.col("said_vs_did_gap"), F.col("said_vs_did_classification")
    expected = said - F.coalesce(did, F.lit(0.0))
    rows = failing(
        df,
        ["technology_name", "year"],
        [
            F.when(
                F.abs(gap - expected) > tolerance,
                _text(
                    "gap_calculation_error (actual=",
                    gap,
                    ", expected=",
                    round_half_away(expected, 2),
                    ")",
                ),
            ),
            F.when(
                ((label == "over_reported") & (gap < 0)) | ((label == "under_reported") & (gap > 0)),
                "classification_inconsistent_with_gap",
            ),
            F.when(said.isNull() & did.isNull(), "no_survey_or_github_data"),
        ],
    )
    return _named(_duplicates(df, ["technology_name", "year"])).unionByName(_named(rows))


def check_salary_mart(
    df: DataFrame,
    low: float = 20_000,
    high: float = 500_000,
    min_respondents: int = 10,
    tolerance: float = 1.0,
) -> DataFrame:
    """Quartiles out of order, unreal medians, wrong premiums, too few respondents."""
    p25, mid, p75 = F.col("p25_salary"), F.col("median_salary"), F.col("p75_salary")
    middle, premium = F.col("global_median_salary"), F.col("salary_premium_pct")
    expected = round_half_away((mid - middle) * 100.0 / F.nullif(middle, F.lit(0.0)), 2)
    both = p25.isNotNull() & p75.isNotNull()
    people = F.col("respondent_count")
    rows = df.withColumnRenamed("survey_year", "year")
    return _named(
        failing(
            rows,
            ["technology_name", "year"],
            [
                F.when(
                    both & (p25 > mid), _text("p25_greater_than_median (", p25, " > ", mid, ")")
                ).when(
                    both & (mid > p75), _text("median_greater_than_p75 (", mid, " > ", p75, ")")
                ),
                F.when(
                    (mid < low) | (mid > high), _text("median_salary_out_of_range ($", mid, ")")
                ),
                F.when(
                    (middle > 0) & (F.abs(premium - expected) > tolerance),
                    "salary_premium_calculation_error",
                ),
                F.when(
                    people < min_respondents,
                    _text("respondent_count_below_threshold (", people, ")"),
                ),
            ],
        )
    )


def check_sentiment_mart(df: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Repeated keys, wrong gaps, rates outside 0-100, stages against the sign of the gap."""
    use, want, gap = F.col("adoption_pct"), F.col("desire_pct"), F.col("desire_gap")
    stage = F.col("lifecycle_stage")
    rows = failing(
        df,
        ["technology_name", "year"],
        [
            F.when(
                F.abs(gap - (want - use)) > tolerance,
                _text(
                    "desire_gap_calculation_error (actual=",
                    gap,
                    ", expected=",
                    round_half_away(want - use, 2),
                    ")",
                ),
            ),
            F.when(
                (use < 0) | (use > 100), _text("adoption_pct_out_of_bounds (", use, ")")
            ).when((want < 0) | (want > 100), _text("desire_pct_out_of_bounds (", want, ")")),
            F.when(
                (stage.isin("emerging", "growing_interest") & (gap < 0))
                | (stage.isin("declining", "established_but_waning") & (gap > 0)),
                "lifecycle_inconsistent_with_desire_gap",
            ),
        ],
    )
    return _named(_duplicates(df, ["technology_name", "year"])).unionByName(_named(rows))


Check = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Declared:
    """A declared check.  One whose failing rows are rows of the table itself also has their
    condition, so that all such checks of a table can be counted in a single pass."""

    failing: Check
    condition: str | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.failing(df)


def _missing(*columns: str) -> dict[str, Declared]:
    return {
        f"not_null_{c}": Declared(lambda df, c=c: check_not_null(df, c), f"{c} IS NULL")
        for c in columns
    }


def _unique(*columns: str) -> dict[str, Declared]:
    return {f"unique_{c}": Declared(lambda df, c=c: check_unique(df, c)) for c in columns}


def _keyed(*columns: str) -> dict[str, Declared]:
    name = f"unique_combination_{'_'.join(columns)}"
    return {name: Declared(lambda df: check_unique_combination(df, columns))}


def _domain(column: str, values: Sequence) -> dict[str, Declared]:
    name = f"accepted_values_{column}"
    return {name: Declared(lambda df: check_accepted_values(df, column, values))}


def _range(low: float, high: float, *columns: str) -> dict[str, Declared]:
    return {
        f"accepted_range_{c}": Declared(
            lambda df, c=c: check_accepted_range(df, c, low, high), f"{c} < {low} OR {c} > {high}"
        )
        for c in columns
    }


# fixed values: the checks declared for each table.  Ranges never judge NULL, and categories
# are the lower-case names the mapping produces.
DECLARED_CHECKS: dict[str, dict[str, Declared]] = {
    "raw_survey_a": _missing("response_id", "survey_year") | _domain("survey_year", SURVEY_YEARS),
    "raw_survey_b": _missing("response_id"),
    "raw_activity": _missing("activity_month", "repo_language"),
    "staged_survey_a": _unique("survey_response_id") | _missing("survey_response_id"),
    "technologies_a": _missing("technology_name")
    | _domain("technology_category", UNPIVOTED_CATEGORIES),
    "staged_survey_b": _unique("survey_response_id") | _missing("survey_response_id"),
    "technologies_b": _missing("technology_name"),
    "staged_activity": _unique("activity_id")
    | _missing("activity_id", "repo_language", "activity_month"),
    "spine": _missing("technology_id", "canonical_name"),
    "dim_technologies": _unique("technology_id", "technology_name")
    | _missing("technology_id", "technology_name", "technology_category")
    | _domain("technology_category", TECHNOLOGY_CATEGORIES),
    "technology_adoption": _keyed("technology_name", "year", "data_source")
    | _missing("technology_name", "year", "data_source")
    | _domain("year", SURVEY_YEARS)
    | _domain("data_source", ALL_SOURCES)
    | _range(0, 100, "survey_adoption_pct", "survey_desire_pct")
    | _range(0, 1, "github_event_share")
    | _range(100, 300_000, "total_respondents"),
    "said_vs_did": _keyed("technology_name", "year")
    | _missing("technology_name", "year", "said_vs_did_classification")
    | _domain("year", SURVEY_YEARS)
    | _domain("said_vs_did_classification", GAP_CLASSES)
    | _range(0, 100, "avg_survey_adoption_pct", "github_activity_pct")
    | _range(-100, 100, "said_vs_did_gap"),
    "salary_by_stack": _missing("technology_name", "survey_year", "median_salary")
    | _domain("survey_year", SURVEY_YEARS)
    | _range(20_000, 500_000, "median_salary", "p25_salary", "p75_salary")
    | _range(1, 100_000, "respondent_count")
    | _range(-90, 500, "salary_premium_pct"),
    "technology_sentiment": _keyed("technology_name", "year")
    | _missing("technology_name", "year", "lifecycle_stage", "adoption_pct", "desire_pct")
    | _domain("year", SURVEY_YEARS)
    | _domain("lifecycle_stage", LIFECYCLE_STAGES)
    | _range(0, 100, "adoption_pct", "desire_pct")
    | _range(-100, 100, "desire_gap"),
}
MART_CHECKS: dict[str, Check] = {
    "technology_adoption": check_adoption_mart,
    "said_vs_did": check_said_vs_did_mart,
    "salary_by_stack": check_salary_mart,
    "technology_sentiment": check_sentiment_mart,
}


def _counted_rows(table: str, df: DataFrame, conditions: dict[str, str]) -> DataFrame:
    """Failing rows per condition, all counted in one pass over the table."""
    totals = df.agg(*[F.expr(f"count_if({c}) AS `{n}`") for n, c in conditions.items()])
    entries = ", ".join(
        f"struct('{n}' AS test_name, `{n}` AS failure_count)" for n in conditions
    )
    return totals.selectExpr(f"inline(array({entries}))").select(
        F.lit(table).alias("model_name"), "test_name", "failure_count"
    )


def run_checks(tables: dict[str, DataFrame], rules: bool = True) -> DataFrame:
    """Status and failing rows of every declared check of the given tables, and of their mart
    checks unless `rules` is off."""
    counted = []
    for table, df in tables.items():
        checks = DECLARED_CHECKS.get(table, {})
        simple = {n: c.condition for n, c in checks.items() if c.condition}
        if simple:
            counted.append(_counted_rows(table, df, simple))
        grouped: dict[str, Check] = {n: c for n, c in checks.items() if not c.condition}
        if rules and table in MART_CHECKS:
            grouped[f"mart_rules_{table}"] = MART_CHECKS[table]
        for name, check in grouped.items():
            failures = check(df).agg(F.count(F.lit(1)).alias("failure_count"))
            counted.append(
                failures.select(
                    F.lit(table).alias("model_name"),
                    F.lit(name).alias("test_name"),
                    "failure_count",
                )
            )
    result = reduce(DataFrame.unionByName, counted)
    status = F.when(F.col("failure_count") > 0, "fail").otherwise("pass").alias("status")
    return result.select("model_name", "test_name", status, "failure_count")


def write_checked(
    df: DataFrame, path: str, table: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write `df` to `path` and count the failing rows of the row checks declared for `table` on
    the way: the counts ride on the write as observed metrics, so no check reads the table again.

    One row per check, as `run_checks` has them.  Checks that group rows need a shuffle of their
    own and are left to `run_checks` on what was written."""
    conditions = {n: c.condition for n, c in DECLARED_CHECKS.get(table, {}).items() if c.condition}
    spark = df.sparkSession
    schema = "model_name string, test_name string, status string, failure_count long"
    if not conditions:
        write_full_refresh(df, path, partition_by)
        return spark.createDataFrame([], schema)
    seen = Observation(f"checks_{table}")
    metrics = [F.expr(f"count_if({c})").alias(f"m{i}") for i, c in enumerate(conditions.values())]
    write_full_refresh(df.observe(seen, *metrics), path, partition_by)
    found = seen.get
    rows = [
        (table, n, "fail" if found[f"m{i}"] else "pass", found[f"m{i}"])
        for i, n in enumerate(conditions)
    ]
    return spark.createDataFrame(rows, schema)
