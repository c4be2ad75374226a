"""Raw table schemas (columns in table order)."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _table(names: str, **special: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, special.get(n, T.StringType())) for n in names.split()])


SURVEY_A = _table(
    """
    response_id survey_year main_branch employment remote_work country us_state ed_level age
    gender trans sexuality ethnicity accessibility years_code years_code_pro dev_type org_size
    currency comp_total comp_freq
    language_have_worked_with language_want_to_work_with
    database_have_worked_with database_want_to_work_with
    platform_have_worked_with platform_want_to_work_with
    webframe_have_worked_with webframe_want_to_work_with
    misc_tech_have_worked_with misc_tech_want_to_work_with
    tools_tech_have_worked_with tools_tech_want_to_work_with
    ne_tech_have_worked_with ne_tech_want_to_work_with
    collab_tools_have_worked_with collab_tools_want_to_work_with
    op_sys_professional op_sys_personal
    ai_select ai_sent ai_tools_currently_using ai_tools_want_to_work_with
    job_sat _extra_fields _loaded_at
    """,
    survey_year=T.IntegerType(),
    _extra_fields=T.VariantType(),
    _loaded_at=T.TimestampNTZType(),
)

SURVEY_B = _table(
    """
    response_id survey_year country age gender employment_status company_size job_role
    years_of_experience primary_language languages_used languages_plan_to_adopt
    frameworks_used ides_used operating_systems industry team_size _extra_fields _loaded_at
    """,
    survey_year=T.IntegerType(),
    _extra_fields=T.VariantType(),
    _loaded_at=T.TimestampNTZType(),
)

EVENT_LOG = _table(
    """
    event_id event_type created_at repo_name repo_id actor_login actor_id org_login
    repo_language repo_stars repo_forks repo_size action commits_count additions deletions
    event_month _loaded_at
    """,
    created_at=T.TimestampNTZType(),
    repo_id=T.LongType(),
    actor_id=T.LongType(),
    repo_stars=T.LongType(),
    repo_forks=T.LongType(),
    repo_size=T.LongType(),
    commits_count=T.LongType(),
    additions=T.LongType(),
    deletions=T.LongType(),
    _loaded_at=T.TimestampNTZType(),
)

MONTHLY_ACTIVITY = _table(
    """
    activity_month repo_language event_type event_count unique_actors unique_repos
    total_commits total_additions total_deletions avg_repo_stars _loaded_at
    """,
    activity_month=T.DateType(),
    event_count=T.LongType(),
    unique_actors=T.LongType(),
    unique_repos=T.LongType(),
    total_commits=T.LongType(),
    total_additions=T.LongType(),
    total_deletions=T.LongType(),
    avg_repo_stars=T.DoubleType(),
    _loaded_at=T.TimestampNTZType(),
)

CHECK_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_at", T.TimestampNTZType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("test_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("failure_count", T.LongType()),
        T.StructField("severity", T.StringType()),
        T.StructField("execution_ms", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project `df` to `schema`: same order and types, missing columns as typed NULLs."""
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()})"
            f" AS {f.name}"
            for f in schema.fields
        ]
    )
