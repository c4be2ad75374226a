"""The given star-schema tables seen as surveys, activity and check logs.

A customer's year is a respondent of survey A, an order is a respondent of survey B, part
brands are technologies, and shipped lines are activity.  Every line is a mention: of a brand
that is used, wanted, or both.  A respondent's brands travel as a set of numbers, one set an order;
the list text is made after the shuffle.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from devpulse.operators.aggregates import grouped_distinct_counts
from devpulse.operators.reshape import technology_rows_a, technology_rows_b
from devpulse.operators.staging import stage_activity, stage_survey_a, stage_survey_b
from devpulse.plans.activity import activity_yearly
from devpulse.plans.adoption import adoption_a, adoption_b, technology_adoption
from devpulse.plans.spine import technologies, technology_spine
from devpulse.sources.sinks import cut_lineage

MAPPED_BRANDS = 24
CANONICAL_BRANDS = 20
CATEGORIES = ["language", "database", "platform", "web_framework"]
SUBCATEGORIES = ["web", "systems", "data"]
RAW_LISTS = ["language", "database", "platform", "webframe"]
NATURAL_KEY = ("response_id", "survey_year")
# orders of a task that groups by respondent, about
TASK_ORDERS = 100_000


_SCHEMAS: dict[str, StructType] = {}


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A given table.  Its schema is read from the files once per process, since a model opens
    the same tables several times."""
    path = f"{folder}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def respondent_parts(spark: SparkSession, folder: str) -> int:
    """Partitions for grouping by respondent.  Sets of brands are small when shuffled and large when
    exploded, so partitions as adaptive execution would merge them, by shuffled bytes, give tasks
    that need more memory the more data there is; these have about as many orders at any size."""
    needed = -(-load(spark, folder, "orders").count() // TASK_ORDERS)
    return max(needed, spark.sparkContext.defaultParallelism)


def brand_number() -> Column:
    return F.substr(F.col("p_brand"), F.lit(7)).cast("int")


def brand_seed(spark: SparkSession) -> DataFrame:
    """Mapping of brands: the last four mapped ones are second names of the first four, and
    one brand is left unmapped.  24 rows whatever the size of the tables."""
    categories = ", ".join(f"'{c}'" for c in CATEGORIES)
    subcategories = ", ".join(f"'{c}'" for c in SUBCATEGORIES)
    numbered = spark.range(1, MAPPED_BRANDS + 1).selectExpr(
        "CAST(id AS INT) AS k",
        f"CAST(IF(id > {CANONICAL_BRANDS}, id - {CANONICAL_BRANDS}, id) AS INT) AS c",
    )
    return numbered.selectExpr(
        "concat('Brand#', k) AS source_name",
        "concat('Tech#', c) AS canonical_name",
        f"array({categories})[c % 4] AS technology_category",
        f"array({subcategories})[c % 3] AS technology_subcategory",
    )


def line_facts(spark: SparkSession, folder: str) -> DataFrame:
    """What every order line says about its part's brand: used (A), wanted (N), or both (R); and
    the shipment it is.  Short columns, for the surveys and the activity to be made from."""
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_suppkey", "l_linenumber", "l_linestatus", "l_shipdate"
    )
    parts = load(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), brand_number().alias("bn")
    )
    flag = F.col("l_returnflag")
    return lines.join(parts, "l_partkey").select(
        F.col("l_orderkey").alias("o_orderkey"),
        "bn",
        F.when(flag != "N", F.col("bn")).alias("used"),
        F.when(flag != "A", F.col("bn")).alias("desired"),
        F.trunc("l_shipdate", "month").alias("activity_month"),
        (F.col("l_linestatus") == "F").alias("pushed"),
        "l_suppkey",
        "l_linenumber",
    )


def order_sets(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Every order with its customer, year, price and priority, and the sets of brands that its
    lines (`line_facts`) use and want, NULL for an order without lines."""
    said = line_facts(spark, folder) if lines is None else lines
    sets = said.groupBy("o_orderkey").agg(
        F.collect_set("used").alias("used"), F.collect_set("desired").alias("desired")
    )
    orders = load(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.year("o_orderdate").alias("survey_year"),
        "o_totalprice",
        "o_orderpriority",
    )
    return orders.join(sets, "o_orderkey", "left")


@dataclass
class Sources:
    """What several models are made from: the lines, and the orders with their sets of brands."""

    lines: DataFrame
    orders: DataFrame


def shared_sources(spark: SparkSession, folder: str) -> Sources:
    """Each written once where the session has a checkpoint folder, so that the lines are scanned
    and brought together by order once, however many models follow."""
    lines = cut_lineage(line_facts(spark, folder))
    return Sources(lines, cut_lineage(order_sets(spark, folder, lines)))


def list_text(brands: str, of_category: int | None = None) -> str:
    """The names of a set of brands in the order of their numbers, NULL for none."""
    own = brands if of_category is None else f"filter({brands}, b -> b % 4 = {of_category})"
    return f"nullif(concat_ws(';', transform(array_sort({own}), b -> concat('Brand#', b))), '')"


def respondents_a(spark: SparkSession, folder: str) -> DataFrame:
    """Respondents of survey A: every customer and year with an order."""
    return load(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("response_id"),
        F.year("o_orderdate").alias("survey_year"),
    )


def respondents_b(spark: SparkSession, folder: str) -> DataFrame:
    """Respondents of survey B: every order."""
    return load(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("response_id"),
        F.year("o_orderdate").alias("survey_year"),
    )


def raw_survey_a(
    spark: SparkSession, folder: str, profile: bool = False, orders: DataFrame | None = None
) -> DataFrame:
    """Survey A in its raw shape: the orders (`order_sets`) of a customer and year together.
    `profile` adds the answers that come from the customer."""
    told = order_sets(spark, folder) if orders is None else orders
    told = told.withColumn("response_id", F.col("o_custkey").cast("string"))
    told = told.repartition(respondent_parts(spark, folder), *NATURAL_KEY)
    # an entry for the order itself, and one for each brand it names
    order = "named_struct('price', o_totalprice, 'priority', o_orderpriority, 'used', int(NULL), 'desired', int(NULL))"
    entries = [
        f"transform(coalesce({held}, array()), b -> named_struct('price', double(NULL), 'priority', string(NULL), "
        f"'used', {used}, 'desired', {desired}))"
        for held, used, desired in (("used", "b", "int(NULL)"), ("desired", "int(NULL)", "b"))
    ]
    rows = told.select(
        *NATURAL_KEY,
        F.expr(f"inline(concat(array({order}), {', '.join(entries)}))"),
    )
    people = rows.groupBy("response_id", "survey_year").agg(
        F.collect_set("used").alias("used"),
        F.collect_set("desired").alias("desired"),
        F.max("price").alias("price"),
        F.count("price").alias("n_orders"),
        F.min("priority").alias("priority"),
    )
    lists = [
        f"{list_text(brands, k)} AS {name}_{suffix}"
        for brands, suffix in (("used", "have_worked_with"), ("desired", "want_to_work_with"))
        for k, name in enumerate(RAW_LISTS)
    ]
    survey = people.selectExpr(
        "response_id",
        "survey_year",
        "priority AS ed_level",
        "CAST(n_orders AS STRING) AS years_code",
        "CAST(n_orders % 4 AS STRING) AS years_code_pro",
        "CAST(CAST(price AS DECIMAL(18, 2)) AS STRING) AS comp_total",
        "IF(priority = '3-MEDIUM', 'Monthly', 'Yearly') AS comp_freq",
        *lists,
    )
    if not profile:
        return survey
    segment = F.col("c_mktsegment")
    people = load(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("response_id"),
        F.col("c_nationkey").alias("n_nationkey"),
        F.when(segment == "BUILDING", "Student;Data engineer")
        .when(segment == "MACHINERY", "Data Scientist or machine learning specialist")
        .when(segment == "AUTOMOBILE", "Data or business analyst;Database administrator")
        .when(segment == "HOUSEHOLD", "Developer, full-stack")
        .alias("dev_type"),
    )
    nations = load(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return survey.join(people, "response_id", "left").join(nations, "n_nationkey", "left").drop(
        "n_nationkey"
    )


def raw_survey_b(spark: SparkSession, folder: str, orders: DataFrame | None = None) -> DataFrame:
    """Survey B in its raw shape."""
    return survey_b_sets(spark, folder, orders).selectExpr(
        "response_id",
        "survey_year",
        "concat('Brand#', array_min(used)) AS primary_language",
        f"{list_text('used')} AS languages_used",
        f"{list_text('desired')} AS languages_plan_to_adopt",
    )


def survey_b_sets(spark: SparkSession, folder: str, orders: DataFrame | None = None) -> DataFrame:
    told = order_sets(spark, folder) if orders is None else orders
    return told.select(
        F.col("o_orderkey").cast("string").alias("response_id"), "survey_year", "used", "desired"
    )


def brand_options(spark: SparkSession, folder: str) -> list[int]:
    """The options of a wide file: the parts' brands, as many as a file has columns.  They become
    headers, so they come to the driver, as a file's header line does."""
    found = load(spark, folder, "part").select(brand_number().alias("bn")).distinct()
    return sorted(r["bn"] for r in found.collect())


def wide_survey_b(spark: SparkSession, folder: str) -> DataFrame:
    """Survey B as its files have it: one column per option."""
    brands = brand_options(spark, folder)

    def options(held: str, prefix: str) -> list[Column]:
        return [
            F.when(F.array_contains(held, b), f" Brand#{b} ").alias(f"{prefix}Brand#{b}")
            for b in brands
        ]

    return survey_b_sets(spark, folder).select(
        "response_id",
        *options("used", "proglang::"),
        *options("used", "primary_lang::"),
        *options("desired", "adopt_proglang::"),
        *options("used", "os::"),
        *options("desired", "os_dev::"),
        (F.col("survey_year") % 5).cast("string").alias("experience"),
        F.col("survey_year").cast("string").alias("company_coders"),
    )


def wide_survey_b_dotted(spark: SparkSession, folder: str) -> DataFrame:
    """Survey B as its files of 2021 and 2022 have it: dotted headers, a copy of every option of a
    question, and answers that stand for none."""
    brands = brand_options(spark, folder)

    def options(held: str, prefix: str, suffix: str = "") -> list[Column]:
        return [
            F.when(F.array_contains(held, b), f"Brand#{b}\t").alias(f"{prefix}Brand#{b}{suffix}")
            for b in brands
        ]

    none = F.coalesce(F.size("used"), F.lit(0)) <= 0
    return survey_b_sets(spark, folder).select(
        "response_id",
        *options("used", "proglang."),
        *options("used", "proglang.", "_103"),
        F.when(none, "I don't use programming languages").alias("proglang.none"),
        F.lit("I don't use any").alias("primary_proglang.0"),
        *options("used", "primary_proglang."),
        *options("desired", "adopt_proglang."),
        F.lit("No, I'm NOT PLANNING to").alias("adopt_proglang.No"),
        *options("desired", "os_devenv."),
    )


def raw_activity(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Monthly activity in its raw shape: shipped lines (`line_facts`) by month and brand."""
    said = line_facts(spark, folder) if lines is None else lines
    # short fixed-width keys are grouped and shuffled; their names are made afterwards
    counted = grouped_distinct_counts(
        said,
        ["activity_month", "bn", "pushed"],
        {"lines": ("count", "*"), "line_numbers": ("sum", "l_linenumber")},
        {"unique_actors": "l_suppkey", "unique_repos": "o_orderkey"},
    )
    return counted.selectExpr(
        "activity_month",
        "concat('Brand#', bn) AS repo_language",
        "IF(pushed, 'PushEvent', 'PullRequestEvent') AS event_type",
        "lines * bn * bn AS event_count",
        "unique_actors",
        "unique_repos",
        "IF(pushed, line_numbers, NULL) AS total_commits",
        "lines AS total_additions",
        "line_numbers / lines AS avg_repo_stars",
    )


def archive_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events in the shape of an archive, with a JSON payload."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    commits = F.array(*map(F.lit, ["[]", "[1]", "[1,2]", "[1,2,3]"]))[F.col("k") % 4]
    language = F.when(
        F.col("k") % 10 != 0,
        F.concat(
            F.lit('"pull_request":{"base":{"repo":{"language":"Brand#'),
            (F.col("k") % 25 + 1).cast("string"),
            F.lit('"}}},'),
        ),
    ).otherwise("")
    return (
        load(spark, folder, "events")
        .withColumn("k", k)
        .select(
            "event_id",
            F.col("ts").alias("created_at"),
            F.when(kind == "click", "PushEvent")
            .when(kind == "view", "PullRequestEvent")
            .when(kind == "purchase", "IssuesEvent")
            .when(kind == "error", "WatchEvent")
            .otherwise("GollumEvent")
            .alias("type"),
            F.concat(F.lit("{"), language, F.lit('"commits":'), commits, F.lit("}")).alias(
                "payload"
            ),
            F.struct(F.concat(F.lit("repo"), F.col("k").cast("string")).alias("name")).alias(
                "repo"
            ),
            F.struct(F.col("user_id").cast("string").alias("login")).alias("actor"),
        )
    )


def yearly_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly totals per language, for the monthly estimate: orders by priority."""
    year = F.year("o_orderdate") + 24
    return (
        load(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("language"), year.alias("year"))
        .agg(
            F.count(F.lit(1)).alias("repos_pushed"),
            F.count_if(F.col("o_orderstatus") == "F").alias("repos_created"),
            F.count_if(F.col("o_orderstatus") == "O").alias("pr_count"),
            F.count_if(F.col("o_totalprice") > 490000).alias("issue_count"),
        )
        .withColumn("avg_stars", F.col("repos_pushed") / 7.0)
        .withColumn("avg_forks", F.col("pr_count") / 8.0)
    )


def check_log(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as results of five nightly check runs."""
    labels = load(spark, folder, "labels")
    status = (
        F.when(F.col("toxic") == 1, "warn").when(F.col("quality") == 0, "fail").otherwise("pass")
    )
    night = F.col("doc_id") % 5
    return (
        load(spark, folder, "documents")
        .join(labels, "doc_id", "left")
        .select(
            night.cast("string").alias("run_id"),
            F.date_add(F.lit("2024-01-01").cast("date"), night.cast("int"))
            .cast("timestamp_ntz")
            .alias("run_at"),
            F.col("source").alias("model_name"),
            F.concat(F.lit("not_null_"), F.col("doc_id").cast("string")).alias("test_name"),
            F.col("lang").alias("column_name"),
            status.alias("status"),
            F.when(status == "pass", 0).otherwise(F.col("n_chars") % 100 + 1).cast("long").alias(
                "failure_count"
            ),
            F.when(F.col("doc_id") % 3 == 0, "warn").otherwise("error").alias("severity"),
            F.col("n_chars").alias("execution_ms"),
            F.lit(None).cast("string").alias("error_message"),
        )
    )


def check_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as the text a check run prints, with lines in between that are no result."""
    result = F.array(*map(F.lit, ["PASS", "FAIL", "WARN"]))[(F.col("doc_id") % 3).cast("int")]
    test = F.array(
        *map(
            F.lit,
            [
                "not_null_fct_technology_adoption_year",
                "unique_dim_technologies_technology_id",
                "unique_combination_of_columns_fct_said_vs_did",
                "survey_response_ranges_stg_rows_total",
                "some_custom_rule",
                "accepted_values_int_x",
            ],
        )
    )[(F.col("doc_id") % 6).cast("int")]
    failures = F.when(
        F.col("doc_id") % 3 == 1, F.concat(F.lit(" "), (F.col("n_chars") % 50).cast("string"))
    ).otherwise("")
    seconds = F.concat_ws(
        ".", (F.col("n_chars") % 10).cast("string"), (F.col("n_chars") % 90 + 10).cast("string")
    )
    line = F.concat(
        F.lit("12:00:01  "), result, F.lit(" "), test, F.lit(" ........ ["), result, failures,
        F.lit(" in "), seconds, F.lit("s]"),
    )
    return load(spark, folder, "documents").select(
        F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("Found "), F.col("source")))
        .otherwise(line)
        .alias("value")
    )


# --- models on the given tables ------------------------------------------------


def spine(spark: SparkSession) -> DataFrame:
    return technology_spine(brand_seed(spark))


def staged_a(
    spark: SparkSession, folder: str, profile: bool = False, orders: DataFrame | None = None
) -> DataFrame:
    return stage_survey_a(raw_survey_a(spark, folder, profile, orders))


def staged_b(spark: SparkSession, folder: str, orders: DataFrame | None = None) -> DataFrame:
    return stage_survey_b(raw_survey_b(spark, folder, orders))


def yearly_a(
    spark: SparkSession,
    folder: str,
    mapping: DataFrame | None = None,
    orders: DataFrame | None = None,
) -> DataFrame:
    """Survey A's yearly rates.  Respondents are counted by their natural key, which the
    surveys are already partitioned by, so nothing is shuffled between building the surveys
    and the final counts."""
    rows = technology_rows_a(staged_a(spark, folder, orders=orders), NATURAL_KEY)
    mapping = mapping or spine(spark)
    return adoption_a(rows, respondents_a(spark, folder), mapping, NATURAL_KEY)


def yearly_b(
    spark: SparkSession,
    folder: str,
    mapping: DataFrame | None = None,
    orders: DataFrame | None = None,
) -> DataFrame:
    surveys = staged_b(spark, folder, orders).repartition(respondent_parts(spark, folder), *NATURAL_KEY)
    rows = technology_rows_b(surveys, NATURAL_KEY)
    mapping = mapping or spine(spark)
    return adoption_b(rows, respondents_b(spark, folder), mapping, NATURAL_KEY)


def yearly_activity(
    spark: SparkSession,
    folder: str,
    mapping: DataFrame | None = None,
    lines: DataFrame | None = None,
) -> DataFrame:
    monthly = stage_activity(raw_activity(spark, folder, lines))
    return activity_yearly(monthly, mapping or spine(spark))


def yearly_tables(
    spark: SparkSession, folder: str, mapping: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The yearly tables of both surveys and the activity, from one scan of the lines."""
    made = shared_sources(spark, folder)
    return (
        yearly_a(spark, folder, mapping, made.orders),
        yearly_b(spark, folder, mapping, made.orders),
        yearly_activity(spark, folder, mapping, made.lines),
    )


def adoption(
    spark: SparkSession, folder: str, mapping: DataFrame | None = None
) -> DataFrame:
    mapping = mapping or spine(spark)
    return technology_adoption(*yearly_tables(spark, folder, mapping), technologies(mapping))
