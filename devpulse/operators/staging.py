"""Raw tables to typed, renamed rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.constants import UNKNOWN_LANGUAGE
from devpulse.functions import surrogate_key, to_whole_number
from devpulse.sources.schemas import MONTHLY_ACTIVITY, SURVEY_A, SURVEY_B, conform

# --- fixed values: raw column -> staged column ------------------------------
SURVEY_A_RENAMES = {
    "response_id": "response_id",
    "survey_year": "survey_year",
    "main_branch": "developer_status",
    "employment": "employment",
    "remote_work": "remote_work",
    "country": "country",
    "ed_level": "education_level",
    "age": "age",
    "years_code": "years_coding_total",
    "years_code_pro": "years_coding_professional",
    "dev_type": "developer_roles",
    "org_size": "organization_size",
    "currency": "comp_currency",
    "comp_total": "compensation_total",
    "comp_freq": "compensation_frequency",
    "language_have_worked_with": "languages_used",
    "database_have_worked_with": "databases_used",
    "platform_have_worked_with": "platforms_used",
    "webframe_have_worked_with": "web_frameworks_used",
    "misc_tech_have_worked_with": "other_tech_used",
    "tools_tech_have_worked_with": "dev_tools_used",
    "language_want_to_work_with": "languages_desired",
    "database_want_to_work_with": "databases_desired",
    "platform_want_to_work_with": "platforms_desired",
    "webframe_want_to_work_with": "web_frameworks_desired",
    "ai_select": "ai_usage",
    "ai_sent": "ai_sentiment",
    "ai_tools_currently_using": "ai_tools_currently_using",
    "job_sat": "job_satisfaction",
    "_loaded_at": "_loaded_at",
}
NUMERIC_ANSWERS = ["years_coding_total", "years_coding_professional", "compensation_total"]
SURVEY_B_COLUMNS = """
response_id survey_year country age gender employment_status company_size job_role
years_of_experience industry team_size primary_language languages_used
languages_plan_to_adopt frameworks_used ides_used operating_systems _loaded_at
""".split()


def stage_survey_a(raw: DataFrame) -> DataFrame:
    """Respondent-years of survey A: keyed, renamed, three answers turned into numbers."""

    renamed = (
        conform(raw, SURVEY_A)
        .where("response_id IS NOT NULL")
        .selectExpr(*[f"{c} AS {name}" for c, name in SURVEY_A_RENAMES.items()])
    )
    numeric = {name: to_whole_number(F.col(name)) for name in NUMERIC_ANSWERS}
    return renamed.select(
        surrogate_key("response_id", "survey_year").alias("survey_response_id"), "*"
    ).withColumns(numeric)


def stage_survey_b(raw: DataFrame) -> DataFrame:
    """Respondent-years of survey B."""
    return (
        conform(raw, SURVEY_B)
        .where("response_id IS NOT NULL")
        .select(
            surrogate_key("response_id", "survey_year").alias("survey_response_id"),
            *SURVEY_B_COLUMNS,
        )
    )


def stage_activity(raw: DataFrame) -> DataFrame:
    """Monthly activity with a known language and at least one event."""
    zero_filled = ["total_commits", "total_additions", "total_deletions", "avg_repo_stars"]
    return (
        conform(raw, MONTHLY_ACTIVITY)
        .where((F.col("repo_language") != UNKNOWN_LANGUAGE) & (F.col("event_count") > 0))
        .select(
            surrogate_key("activity_month", "repo_language", "event_type").alias("activity_id"),
            "activity_month",
            F.trunc("activity_month", "year").alias("activity_year"),
            "repo_language",
            "event_type",
            "event_count",
            "unique_actors",
            "unique_repos",
            *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in zero_filled],
            "_loaded_at",
        )
    )
