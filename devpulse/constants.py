"""Names, lists, patterns and limits the results depend on.

Everything here is data, not logic.  Each block is a value that has to be
exactly this for the output tables to carry the right names and numbers.
"""

# --- fixed values: data source labels -------------------------------------
SURVEY_A = "stackoverflow"
SURVEY_B = "jetbrains"
ACTIVITY = "github"
SURVEY_SOURCES = [SURVEY_A, SURVEY_B]
ALL_SOURCES = [SURVEY_A, SURVEY_B, ACTIVITY]

# --- fixed values: text that means "no value" in a delimited file ---------
NULL_TOKENS = ["", "NA", "NULL", "null", "None"]

# --- fixed values: surrogate key -------------------------------------------
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"

# --- fixed values: multi-select separator ----------------------------------
LIST_SEPARATOR = ";"

# --- fixed values: header -> raw column of survey A -------------------------
SURVEY_A_HEADERS = {
    "ResponseId": "response_id",
    "MainBranch": "main_branch",
    "Employment": "employment",
    "RemoteWork": "remote_work",
    "Country": "country",
    "US_State": "us_state",
    "EdLevel": "ed_level",
    "Age": "age",
    "Gender": "gender",
    "Trans": "trans",
    "Sexuality": "sexuality",
    "Ethnicity": "ethnicity",
    "Accessibility": "accessibility",
    "YearsCode": "years_code",
    "YearsCodePro": "years_code_pro",
    "DevType": "dev_type",
    "OrgSize": "org_size",
    "Currency": "currency",
    "CompTotal": "comp_total",
    "CompFreq": "comp_freq",
    "LanguageHaveWorkedWith": "language_have_worked_with",
    "LanguageWantToWorkWith": "language_want_to_work_with",
    "DatabaseHaveWorkedWith": "database_have_worked_with",
    "DatabaseWantToWorkWith": "database_want_to_work_with",
    "PlatformHaveWorkedWith": "platform_have_worked_with",
    "PlatformWantToWorkWith": "platform_want_to_work_with",
    "WebframeHaveWorkedWith": "webframe_have_worked_with",
    "WebframeWantToWorkWith": "webframe_want_to_work_with",
    "MiscTechHaveWorkedWith": "misc_tech_have_worked_with",
    "MiscTechWantToWorkWith": "misc_tech_want_to_work_with",
    "ToolsTechHaveWorkedWith": "tools_tech_have_worked_with",
    "ToolsTechWantToWorkWith": "tools_tech_want_to_work_with",
    "NEWCollabToolsHaveWorkedWith": "collab_tools_have_worked_with",
    "NEWCollabToolsWantToWorkWith": "collab_tools_want_to_work_with",
    "OpSysProfessional use": "op_sys_professional",
    "OpSysPersonal use": "op_sys_personal",
    "AISelect": "ai_select",
    "AISent": "ai_sent",
    "AIToolCurrently Using": "ai_tools_currently_using",
    "AIToolInterested in": "ai_tools_want_to_work_with",
    "AIToolNot interested in": "ai_tools_want_to_work_with",
    "JobSat": "job_sat",
    "OfficeStackSyncHaveWorkedWith": "collab_tools_have_worked_with",
    "OfficeStackSyncWantToWorkWith": "collab_tools_want_to_work_with",
    "OfficeStackAsyncHaveWorkedWith": "collab_tools_have_worked_with",
    "OfficeStackAsyncWantToWorkWith": "collab_tools_want_to_work_with",
    "NEWSOSites": "ne_tech_have_worked_with",
    "WorkExp": "years_code_pro",
    "AIToolHaveWorkedWith": "ai_tools_currently_using",
    "AIToolWantToWorkWith": "ai_tools_want_to_work_with",
}

# --- fixed values: wide multi-select header prefixes of survey B ------------
# '::' files (2023 and later) and '.' files (2021, 2022)
WIDE_PREFIXES_COLON = {
    "languages_used": ["proglang::"],
    "languages_plan_to_adopt": ["adopt_proglang::"],
    "ides_used": ["ide::"],
    "operating_systems": ["os::", "os_dev::"],
    "job_role": ["job_role::"],
    "industry": ["company_sector::"],
}
PRIMARY_PREFIX_COLON_2023 = "primary_proglang::"
PRIMARY_PREFIX_COLON_2024 = "primary_lang::"
WIDE_PREFIXES_DOT = {
    "languages_used": ["proglang."],
    "languages_plan_to_adopt": ["adopt_proglang."],
    "operating_systems": ["os_devenv."],
    "job_role": ["job_role."],
    "industry": ["company_sector."],
}
PRIMARY_PREFIX_DOT = "primary_proglang."
META_ANSWERS_EXACT_CASE = ["I don't use"]
META_ANSWERS_ANY_CASE = ["not planning"]
DUPLICATE_HEADER_SUFFIX = "_103"

# raw column -> header names tried in order; the first header present is read
SURVEY_B_FIELDS_COLON = {
    "response_id": ["response_id"],
    "country": ["country"],
    "age": ["age_range"],
    "gender": ["gender"],
    "employment_status": ["employment_status"],
    "company_size": ["company_size"],
    "years_of_experience": ["dev_experience", "experience"],
    "team_size": ["team_size", "company_coders"],
}
SURVEY_B_FIELDS_DOT = {
    "response_id": ["response_id"],
    "country": ["country"],
    "age": ["age_range"],
    "gender": ["gender"],
    "employment_status": ["employment_status"],
    "company_size": ["company_size"],
    "years_of_experience": ["dev_experience"],
    "team_size": ["team_size"],
}

# --- fixed values: archive events and the monthly estimate ------------------
ARCHIVE_EVENT_TYPES = [
    "PushEvent",
    "PullRequestEvent",
    "IssuesEvent",
    "CreateEvent",
    "ForkEvent",
    "WatchEvent",
    "PullRequestReviewEvent",
    "ReleaseEvent",
]
ARCHIVE_LANGUAGE_PATH = "$.pull_request.base.repo.language"
ARCHIVE_COMMITS_PATH = "$.commits"
PUSH_EVENT = "PushEvent"
UNKNOWN_LANGUAGE = "Unknown"
MIN_MONTHLY_EVENTS = 10
PUSHES_PER_REPO = 8
FORK_RATE = 0.05
PUSH_RATIO = 0.45
WATCH_RATIO = 0.10
SHORT_YEAR = 2025
SHORT_YEAR_MONTHS = 11

# --- fixed values: pay filter ------------------------------------------------
PAY_LOW = 10_000
PAY_HIGH = 1_000_000
PAY_FREQUENCY = "Yearly"

# --- fixed values: said-versus-did and anomaly rules -------------------------
GAP_FACTOR = 1.5
ANOMALY_SIGMAS = 2
ANOMALY_HIGH_SIGMAS = 3
ANOMALY_MIN_HISTORY = 2

# --- fixed values: roles and the answers that count as them ------------------
ROLE_ALIASES = {
    "Data engineer": ["Data engineer", "Engineer, data"],
    "Data scientist / ML": [
        "Data scientist or machine learning specialist",
        "Data scientist",
        "AI/ML engineer",
    ],
    "Data / Business analyst": ["Data or business analyst"],
    "Database administrator": [
        "Database administrator",
        "Database administrator or engineer",
    ],
}
SKILL_COLUMNS = {
    "Languages": "language_have_worked_with",
    "Databases": "database_have_worked_with",
    "Cloud Platforms": "platform_have_worked_with",
    "Libraries & Frameworks": "misc_tech_have_worked_with",
    "Dev Tools": "tools_tech_have_worked_with",
    "IDEs & Editors": "collab_tools_have_worked_with",
}

# --- fixed values: domains of the declared checks ----------------------------
SURVEY_YEARS = [2021, 2022, 2023, 2024, 2025]
GAP_CLASSES = ["over_reported", "under_reported", "consistent"]
LIFECYCLE_STAGES = [
    "emerging",
    "growing_interest",
    "declining",
    "established_but_waning",
    "stable",
]
TECHNOLOGY_CATEGORIES = ["language", "web_framework", "database", "platform", "dev_tool"]
UNPIVOTED_CATEGORIES = [
    "language",
    "database",
    "platform",
    "web_framework",
    "other_tech",
    "dev_tool",
]

# --- fixed values: freshness limits in hours ---------------------------------
SURVEY_FRESHNESS_HOURS = (720, 1440)
ACTIVITY_FRESHNESS_HOURS = (72, 168)
DASHBOARD_FRESH_HOURS = 72
DASHBOARD_STALE_HOURS = 168

# --- fixed values: text of a check run ---------------------------------------
CHECK_LINE = (
    r"(PASS|FAIL|WARN)\s+([\w\.]+)\s+\.+\s+\[(PASS|FAIL|WARN)(?:\s+(\d+))?\s+in\s+([\d\.]+)s\]"
)
CHECK_NAME_PREFIXES = [
    "not_null_",
    "unique_",
    "accepted_values_",
    "accepted_range_",
    "relationships_",
    "unique_combination_of_columns_",
    "dbt_utils_",
    "technology_name_standardization_",
    "survey_response_ranges_",
    "github_activity_validity_",
]
CHECK_TYPES = [
    "not_null",
    "unique",
    "accepted_values",
    "accepted_range",
    "relationships",
    "unique_combination_of_columns",
    "technology_name_standardization",
    "survey_response_ranges",
    "github_activity_validity",
]
MODEL_MARKERS = ["fct_", "dim_", "stg_", "int_"]

# --- fixed values: source name -> canonical name, category, subcategory ------
NAME_MAPPING = [
    ("JavaScript", "JavaScript", "language", "web"),
    ("Javascript", "JavaScript", "language", "web"),
    ("TypeScript", "TypeScript", "language", "web"),
    ("Typescript", "TypeScript", "language", "web"),
    ("Python", "Python", "language", "general"),
    ("Java", "Java", "language", "general"),
    ("C#", "C#", "language", "general"),
    ("Csharp", "C#", "language", "general"),
    ("C++", "C++", "language", "systems"),
    ("Cpp", "C++", "language", "systems"),
    ("C", "C", "language", "systems"),
    ("PHP", "PHP", "language", "web"),
    ("Ruby", "Ruby", "language", "web"),
    ("Go", "Go", "language", "systems"),
    ("Golang", "Go", "language", "systems"),
    ("Rust", "Rust", "language", "systems"),
    ("Swift", "Swift", "language", "mobile"),
    ("Kotlin", "Kotlin", "language", "mobile"),
    ("Dart", "Dart", "language", "mobile"),
    ("Scala", "Scala", "language", "data"),
    ("R", "R", "language", "data"),
    ("MATLAB", "MATLAB", "language", "data"),
    ("Lua", "Lua", "language", "scripting"),
    ("Perl", "Perl", "language", "scripting"),
    ("Shell", "Shell", "language", "scripting"),
    ("Bash/Shell", "Shell", "language", "scripting"),
    ("PowerShell", "PowerShell", "language", "scripting"),
    ("SQL", "SQL", "language", "data"),
    ("HTML/CSS", "HTML/CSS", "language", "web"),
    ("Elixir", "Elixir", "language", "general"),
    ("Clojure", "Clojure", "language", "general"),
    ("Haskell", "Haskell", "language", "general"),
    ("Julia", "Julia", "language", "data"),
    ("Zig", "Zig", "language", "systems"),
    ("Assembly", "Assembly", "language", "systems"),
    ("Objective-C", "Objective-C", "language", "mobile"),
    ("React", "React", "web_framework", "frontend"),
    ("React.js", "React", "web_framework", "frontend"),
    ("Angular", "Angular", "web_framework", "frontend"),
    ("Vue.js", "Vue.js", "web_framework", "frontend"),
    ("Vue", "Vue.js", "web_framework", "frontend"),
    ("Svelte", "Svelte", "web_framework", "frontend"),
    ("Next.js", "Next.js", "web_framework", "fullstack"),
    ("NextJS", "Next.js", "web_framework", "fullstack"),
    ("Nuxt.js", "Nuxt.js", "web_framework", "fullstack"),
    ("Django", "Django", "web_framework", "backend"),
    ("Flask", "Flask", "web_framework", "backend"),
    ("FastAPI", "FastAPI", "web_framework", "backend"),
    ("Express", "Express.js", "web_framework", "backend"),
    ("Express.js", "Express.js", "web_framework", "backend"),
    ("Spring", "Spring", "web_framework", "backend"),
    ("Spring Boot", "Spring Boot", "web_framework", "backend"),
    ("Ruby on Rails", "Rails", "web_framework", "backend"),
    ("Rails", "Rails", "web_framework", "backend"),
    ("Laravel", "Laravel", "web_framework", "backend"),
    ("ASP.NET", "ASP.NET", "web_framework", "backend"),
    ("ASP.NET Core", "ASP.NET Core", "web_framework", "backend"),
    ("Node.js", "Node.js", "platform", "backend"),
    ("NodeJS", "Node.js", "platform", "backend"),
    ("Deno", "Deno", "platform", "backend"),
    ("Bun", "Bun", "platform", "backend"),
    ("jQuery", "jQuery", "web_framework", "frontend"),
    ("htmx", "htmx", "web_framework", "frontend"),
    ("PostgreSQL", "PostgreSQL", "database", "relational"),
    ("Postgres", "PostgreSQL", "database", "relational"),
    ("MySQL", "MySQL", "database", "relational"),
    ("SQLite", "SQLite", "database", "relational"),
    ("Microsoft SQL Server", "SQL Server", "database", "relational"),
    ("SQL Server", "SQL Server", "database", "relational"),
    ("Oracle", "Oracle DB", "database", "relational"),
    ("MongoDB", "MongoDB", "database", "nosql"),
    ("Redis", "Redis", "database", "nosql"),
    ("Elasticsearch", "Elasticsearch", "database", "nosql"),
    ("DynamoDB", "DynamoDB", "database", "nosql"),
    ("Firebase", "Firebase", "database", "nosql"),
    ("Cassandra", "Cassandra", "database", "nosql"),
    ("Neo4j", "Neo4j", "database", "nosql"),
    ("Snowflake", "Snowflake", "database", "cloud_dw"),
    ("BigQuery", "BigQuery", "database", "cloud_dw"),
    ("Databricks", "Databricks", "database", "cloud_dw"),
    ("ClickHouse", "ClickHouse", "database", "analytics"),
    ("AWS", "AWS", "platform", "cloud"),
    ("Amazon Web Services", "AWS", "platform", "cloud"),
    ("Azure", "Azure", "platform", "cloud"),
    ("Microsoft Azure", "Azure", "platform", "cloud"),
    ("Google Cloud", "GCP", "platform", "cloud"),
    ("Google Cloud Platform", "GCP", "platform", "cloud"),
    ("Docker", "Docker", "platform", "devops"),
    ("Kubernetes", "Kubernetes", "platform", "devops"),
    ("Jupyter Notebook", "Jupyter Notebook", "dev_tool", "ide"),
    ("HCL", "HCL", "language", "devops"),
]
