"""The declared checks of every table as queries, and SQL made from short lists of what they ask."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devpulse import adapters as A
from devpulse.constants import (
    ALL_SOURCES,
    GAP_CLASSES,
    LIFECYCLE_STAGES,
    SURVEY_YEARS,
    TECHNOLOGY_CATEGORIES,
    UNPIVOTED_CATEGORIES,
)
from devpulse.operators.reshape import unpivot_survey_a, unpivot_survey_b
from devpulse.plans.dimension import dim_technologies
from devpulse.quality.marts import run_checks
from devpulse.registry import marts as M
from devpulse.registry.base import query


def missing(*columns: str) -> list[str]:
    return [
        f"select 'not_null_{c}', count(*) filter ({c} is null) from t"
        for c in columns
    ]


def repeated(name: str, *columns: str) -> list[str]:
    # a single column is unique among its values; in a combination NULL is a value like others
    known = f"{columns[0]} is not null" if len(columns) == 1 else "true"
    return [
        f"""select '{name}_{"_".join(columns)}', count(*) from
            (select 1 from t where {known} group by {", ".join(columns)} having count(*) > 1)"""
    ]


def outside(column: str, values: list) -> list[str]:
    listed = ", ".join(map(repr, values))
    return [
        f"""select 'accepted_values_{column}', count(distinct {column})
            from t where {column} not in ({listed})"""
    ]


def beyond(low: float, high: float, *columns: str) -> list[str]:
    return [
        f"""select 'accepted_range_{c}', count(*) from t where {c} not between {low} and {high}"""
        for c in columns
    ]


# defects put into each table before it is checked: rows that meet the condition are there twice
# more, the second time with other values.  The same text for Spark and for the checking SQL.
NO_TEXT, NO_NUMBER = "cast(null as string)", "cast(null as int)"
PLANTED: dict[str, tuple[str, dict[str, str]]] = {
    "raw_activity": ("event_count > 50000", {"repo_language": NO_TEXT}),
    "raw_survey_a": ("survey_year = 1995", {"response_id": NO_TEXT, "survey_year": "2021"}),
    "raw_survey_b": ("survey_year = 1995", {"response_id": NO_TEXT}),
    "staged_survey_a": ("survey_year = 1996", {"survey_response_id": NO_TEXT}),
    "staged_survey_b": ("survey_year = 1996", {"survey_response_id": NO_TEXT}),
    "technologies_a": (
        "survey_year = 1997 and is_desired",
        {"technology_name": NO_TEXT, "technology_category": "concat('old ', technology_category)"},
    ),
    "technologies_b": ("survey_year = 1997", {"technology_name": NO_TEXT}),
    "spine": ("technology_category = 'database'", {"technology_id": NO_TEXT, "canonical_name": NO_TEXT}),
    "dim_technologies": (
        "technology_subcategory = 'web'",
        {"technology_id": NO_TEXT, "technology_category": "concat('no ', technology_category)"},
    ),
    "technology_adoption": (
        "year = 1996",
        {
            "technology_name": NO_TEXT,
            "year": "2024",
            "data_source": "concat('old ', data_source)",
            "survey_desire_pct": "survey_desire_pct + 200",
            "github_event_share": "github_event_share - 1",
            "total_respondents": "total_respondents + 300000",
        },
    ),
    "said_vs_did": (
        "year = 1997",
        {
            "said_vs_did_classification": "concat('un', said_vs_did_classification)",
            "avg_survey_adoption_pct": "avg_survey_adoption_pct + 100",
            "said_vs_did_gap": "said_vs_did_gap - 200",
        },
    ),
    "salary_by_stack": (
        "survey_year = 1994",
        {"technology_name": NO_TEXT, "median_salary": "median_salary + 500000", "p25_salary": "p25_salary / 100"},
    ),
    "technology_sentiment": (
        "year = 1995",
        {
            "year": NO_NUMBER,
            "lifecycle_stage": "concat('very ', lifecycle_stage)",
            "desire_pct": "desire_pct + 100",
            "desire_gap": "desire_gap + 150",
        },
    ),
}


def sql(model: str, view: str, *tests: list[str]) -> str:
    every = " union all ".join(x for some in tests for x in some)
    condition, other = PLANTED[model]
    replaced = ", ".join(f"{value} as {c}" for c, value in other.items())
    return f"""
        with clean as (select * from {view}),
             t as (select * from clean union all select * from clean where {condition}
                   union all select * replace ({replaced}) from clean where {condition})
        select '{model}' as model_name, test_name, if(n > 0, 'fail', 'pass') as status,
               cast(n as bigint) as failure_count from ({every}) as r(test_name, n)"""


def checked(name: str, df: DataFrame) -> DataFrame:
    """The table's declared checks, after the defects have been put in."""
    clean = M.stored(df)
    condition, other = PLANTED[name]
    some = clean.where(condition)
    kinds = dict(clean.dtypes)
    changed = some.withColumns({c: F.expr(v).cast(kinds[c]) for c, v in other.items()})
    return run_checks({name: clean.unionByName(some).unionByName(changed)}, rules=False)


@query(
    "declared_raw_activity",
    sql("raw_activity", "monthly", missing("activity_month", "repo_language")),
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return checked("raw_activity", A.raw_activity(spark, d))


@query(
    "declared_raw_survey_a",
    sql(
        "raw_survey_a",
        "people_a",
        missing("response_id", "survey_year"),
        outside("survey_year", SURVEY_YEARS),
    ),
)
def _(spark, d):
    return checked("raw_survey_a", A.raw_survey_a(spark, d))


@query("declared_raw_survey_b", sql("raw_survey_b", "people_b", missing("response_id")))
def _(spark, d):
    return checked("raw_survey_b", A.raw_survey_b(spark, d))


STAGED = "(select *, md5(response_id || '-' || survey_year) as survey_response_id from {})"


@query(
    "declared_staged_survey_a",
    sql(
        "staged_survey_a",
        STAGED.format("people_a"),
        repeated("unique", "survey_response_id"),
        missing("survey_response_id"),
    ),
)
def _(spark, d):
    return checked("staged_survey_a", A.staged_a(spark, d))


@query(
    "declared_staged_survey_b",
    sql(
        "staged_survey_b",
        STAGED.format("people_b"),
        repeated("unique", "survey_response_id"),
        missing("survey_response_id"),
    ),
)
def _(spark, d):
    return checked("staged_survey_b", A.staged_b(spark, d))


@query(
    "declared_technologies_a",
    sql(
        "technologies_a",
        "tech_a",
        missing("technology_name"),
        outside("technology_category", UNPIVOTED_CATEGORIES),
    ),
)
def _(spark, d):
    return checked("technologies_a", unpivot_survey_a(A.staged_a(spark, d)))


@query("declared_technologies_b", sql("technologies_b", "tech_b", missing("technology_name")))
def _(spark, d):
    return checked("technologies_b", unpivot_survey_b(A.staged_b(spark, d)))


@query("declared_spine", sql("spine", "spine", missing("technology_id", "canonical_name")))
def _(spark, d):
    return checked("spine", A.spine(spark))


@query(
    "declared_dim_technologies",
    sql(
        "dim_technologies",
        "techs",
        repeated("unique", "technology_id"),
        repeated("unique", "technology_name"),
        missing("technology_id", "technology_name", "technology_category"),
        outside("technology_category", TECHNOLOGY_CATEGORIES),
    ),
)
def _(spark, d):
    yearly = A.yearly_tables(spark, d, A.spine(spark))
    return checked("dim_technologies", dim_technologies(A.spine(spark), *yearly))


@query(
    "declared_technology_adoption",
    sql(
        "technology_adoption",
        "adoption",
        repeated("unique_combination", "technology_name", "year", "data_source"),
        missing("technology_name", "year", "data_source"),
        outside("year", SURVEY_YEARS),
        outside("data_source", ALL_SOURCES),
        beyond(0, 100, "survey_adoption_pct", "survey_desire_pct"),
        beyond(0, 1, "github_event_share"),
        beyond(100, 300_000, "total_respondents"),
    ),
)
def _(spark, d):
    return checked("technology_adoption", A.adoption(spark, d))


@query(
    "declared_said_vs_did",
    sql(
        "said_vs_did",
        "svd",
        repeated("unique_combination", "technology_name", "year"),
        missing("technology_name", "year", "said_vs_did_classification"),
        outside("year", SURVEY_YEARS),
        outside("said_vs_did_classification", GAP_CLASSES),
        beyond(0, 100, "avg_survey_adoption_pct", "github_activity_pct"),
        beyond(-100, 100, "said_vs_did_gap"),
    ),
)
def _(spark, d):
    return checked("said_vs_did", M.svd(spark, d))


@query(
    "declared_salary_by_stack",
    sql(
        "salary_by_stack",
        "salary",
        missing("technology_name", "survey_year", "median_salary"),
        outside("survey_year", SURVEY_YEARS),
        beyond(20_000, 500_000, "median_salary", "p25_salary", "p75_salary"),
        beyond(1, 100_000, "respondent_count"),
        beyond(-90, 500, "salary_premium_pct"),
    ),
)
def _(spark, d):
    return checked("salary_by_stack", M.salary(spark, d))


@query(
    "declared_technology_sentiment",
    sql(
        "technology_sentiment",
        "sentiment",
        repeated("unique_combination", "technology_name", "year"),
        missing("technology_name", "year", "lifecycle_stage", "adoption_pct", "desire_pct"),
        outside("year", SURVEY_YEARS),
        outside("lifecycle_stage", LIFECYCLE_STAGES),
        beyond(0, 100, "adoption_pct", "desire_pct"),
        beyond(-100, 100, "desire_gap"),
    ),
)
def _(spark, d):
    return checked("technology_sentiment", M.sentiment(spark, d))
