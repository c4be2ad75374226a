"""Reading-side operators: header maps, wide options, event scans, load counts."""

from pyspark.sql import functions as F

from devpulse import adapters as A
from devpulse.constants import SURVEY_A_HEADERS
from devpulse.operators.reshape import explode_multiselect
from devpulse.registry.base import query
from devpulse.sources.activity import expand_year_to_months
from devpulse.sources.catalog import (
    activity_counts,
    load_counts,
    sample_table,
    source_counts,
    top_values,
)
from devpulse.sources.files import events_between, load_survey_years, map_columns, scan_csv, scan_events
from devpulse.sources.sinks import (
    append_results,
    cut_lineage,
    scratch_path,
    write_full_refresh,
    write_replace_years,
)
from devpulse.sources.wide import (
    collect_wide_multiselect,
    first_present_field,
    first_selected,
    load_wide_survey,
)


def scratch(spark):
    """Where round trips write: a new path in the folder that all executors share."""
    path = scratch_path(spark)
    if path is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return path


def as_file(spark, d):
    """Survey A as its file has it: original headers, padded and quoted cells."""
    raw = A.raw_survey_a(spark, d)
    headers = {target: header for header, target in reversed(SURVEY_A_HEADERS.items())}
    return raw.select(
        *[
            F.concat(F.lit(' "'), F.col(c), F.lit('"\t')).alias(headers[c])
            for c in raw.columns
            if c in headers
        ],
        F.lit("9").alias("WorkExp"),
        F.col("survey_year").alias("Unmapped"),
    )


@query(
    "map_columns",
    """select cast(1999 as integer) as survey_year, response_id, priority as ed_level,
              cast(n_orders as varchar) as years_code,
              cast(n_orders % 4 as varchar) as years_code_pro,
              cast(cast(price as decimal(18, 2)) as varchar) as comp_total
       from people_a""",
)
def _(spark, d):
    mapped = map_columns(as_file(spark, d), SURVEY_A_HEADERS, 1999)
    return mapped.select(
        "survey_year", "response_id", "ed_level", "years_code", "years_code_pro", "comp_total"
    )


OPTIONS_SQL = """
    with o as (
        select response_id, string_agg(p_brand, ';' order by bn) filter (where used) as used,
               string_agg(p_brand, ';' order by bn) filter (where desired) as wanted,
               min(bn) filter (where used) as first_used
        from (select l_orderkey, p_brand, bn, bool_or(used) as used, bool_or(desired) as desired
              from mention group by all)
        join people_b on l_orderkey = o_orderkey group by 1)
"""


@query(
    "load_wide_survey",
    OPTIONS_SQL
    + """select response_id, cast(2024 as integer) as survey_year,
                'Brand#' || first_used as primary_language, used as languages_used,
                wanted as languages_plan_to_adopt, coalesce(used, wanted) as operating_systems,
                cast(p.survey_year % 5 as varchar) as years_of_experience,
                cast(p.survey_year as varchar) as team_size
         from people_b p left join o using (response_id)""",
)
def _(spark, d):
    return load_wide_survey(A.wide_survey_b(spark, d), 2024).select(
        "response_id",
        "survey_year",
        "primary_language",
        "languages_used",
        "languages_plan_to_adopt",
        "operating_systems",
        "years_of_experience",
        "team_size",
    )


@query(
    "collect_wide_multiselect",
    OPTIONS_SQL
    + """select response_id, used as languages, coalesce(used, wanted) as systems
         from people_b left join o using (response_id)""",
)
def _(spark, d):
    wide = A.wide_survey_b(spark, d)
    return wide.select(
        "response_id",
        collect_wide_multiselect(wide, "proglang::").alias("languages"),
        collect_wide_multiselect(wide, "os::", "os_dev::").alias("systems"),
    )


@query(
    "first_selected",
    OPTIONS_SQL
    + """select response_id, 'Brand#' || first_used as primary_language
         from people_b left join o using (response_id)""",
)
def _(spark, d):
    wide = A.wide_survey_b(spark, d)
    return wide.select(
        "response_id", first_selected(wide, "primary_lang::").alias("primary_language")
    )


@query(
    "first_present_field",
    """select response_id, cast(survey_year % 5 as varchar) as experience,
              cast(survey_year as varchar) as team, null::varchar as absent from people_b""",
)
def _(spark, d):
    wide = A.wide_survey_b(spark, d)
    return wide.select(
        "response_id",
        first_present_field(wide, ["dev_experience", "experience"]).alias("experience"),
        first_present_field(wide, ["team_size", "company_coders"]).alias("team"),
        first_present_field(wide, ["no_such_header"]).alias("absent"),
    )


@query(
    "scan_events",
    """select event_id, event_type, ts from events
       where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-21'
         and event_type in ('click', 'view')""",
)
def _(spark, d):
    events = A.load(spark, d, "events")
    days = ("2024-01-05", "2024-01-20")
    rows = events_between(events, *days, ["click", "view"], "ts", "event_type")
    return rows.select("event_id", "event_type", "ts")


@query(
    "load_counts",
    """select cast(year(o_orderdate) as integer) as survey_year, count(*) as row_count
       from orders group by 1""",
)
def _(spark, d):
    return load_counts(A.respondents_b(spark, d), "survey_year")


@query(
    "source_counts",
    """select 'orders' as source, count(*) as row_count from orders
       union all select 'lineitem', count(*) from lineitem
       union all select 'events', count(*) from events""",
)
def _(spark, d):
    return source_counts({t: A.load(spark, d, t) for t in ("orders", "lineitem", "events")})


@query(
    "activity_counts_by_language",
    """select repo_language, count(*) as row_count, cast(sum(event_count) as bigint) as events
       from monthly group by 1""",
)
def _(spark, d):
    return activity_counts(A.raw_activity(spark, d), "repo_language")


@query(
    "activity_counts_by_year",
    """select cast(year(activity_month) as integer) as activity_year, count(*) as row_count,
              cast(sum(event_count) as bigint) as events from monthly group by 1""",
)
def _(spark, d):
    return activity_counts(A.raw_activity(spark, d), "activity_year")


@query(
    "top_values",
    """select 'Brand#' || first_bn as primary_language, count(*) as row_count
       from (select l_orderkey, min(bn) as first_bn from mention where used group by 1)
       join people_b on l_orderkey = o_orderkey
       group by 1 order by 2 desc, 1 limit 10""",
)
def _(spark, d):
    return top_values(A.raw_survey_b(spark, d), "primary_language", 10)


@query(
    "sample_table",
    "select * from orders order by o_orderkey limit 50",
)
def _(spark, d):
    return sample_table(A.load(spark, d, "orders"), 50, "first_column")


@query(
    "expand_year_to_months",
    """with y as (
           select o_orderpriority as language, cast(year(o_orderdate) + 24 as integer) as year,
                  count(*) as pushed, count(*) filter (where o_orderstatus = 'F') as created,
                  count(*) filter (where o_orderstatus = 'O') as prs,
                  count(*) filter (where o_totalprice > 490000) as issues
           from orders group by all),
       m as (
           select *, case when year < 2025 then 12 else 11 end as months,
                  pushed / 7.0::double as avg_stars, prs / 8.0::double as avg_forks from y),
       e as (
           select *, unnest([
               {'event_type': 'PushEvent', 'total': pushed * 8},
               {'event_type': 'CreateEvent', 'total': created},
               {'event_type': 'PullRequestEvent', 'total': prs},
               {'event_type': 'IssuesEvent', 'total': issues},
               {'event_type': 'ForkEvent',
                'total': cast(floor(avg_forks * created * 0.05::double) as bigint)},
               {'event_type': 'WatchEvent',
                'total': cast(floor(pushed * 8 * 0.10::double / 0.45::double) as bigint)}],
               recursive := true) from m),
       c as (
           select *, greatest(1, total // months) as n, unnest(range(1, months + 1)) as month
           from e),
       a as (
           select *, greatest(1, n // case event_type when 'PushEvent' then 10
                   when 'PullRequestEvent' then 5 when 'CreateEvent' then 2 else 8 end) as actors
           from c)
       select make_date(year, cast(month as integer), 1) as activity_month,
              language as repo_language, event_type, n as event_count,
              actors as unique_actors,
              case event_type when 'PushEvent' then greatest(1, pushed // months)
                   when 'PullRequestEvent' then greatest(1, actors // 2)
                   when 'CreateEvent' then n else greatest(1, n // 12) end as unique_repos,
              case event_type when 'PushEvent' then n * 3 else 0 end as total_commits,
              cast(0 as bigint) as total_additions, cast(0 as bigint) as total_deletions,
              round(avg_stars, 1) as avg_repo_stars
       from a""",
)
def _(spark, d):
    return expand_year_to_months(A.yearly_totals(spark, d))


@query(
    "wide_options_exploded",
    """select p_brand as language, count(*) as respondents from (
           select distinct l_orderkey, p_brand from mention where used) group by 1""",
)
def _(spark, d):
    """Options folded into a list and exploded again."""
    wide = A.wide_survey_b(spark, d)
    lists = wide.select(collect_wide_multiselect(wide, "proglang::").alias("languages"))
    rows = explode_multiselect(lists, "languages", name="language")
    return rows.groupBy("language").agg(F.count(F.lit(1)).alias("respondents"))




# --- round trips through files ---------------------------------------------------

NULLED = "case when {0} in ('', 'NA', 'NULL', 'null', 'None') then null else {0} end as {0}"


@query(
    "scan_csv",
    f"select conv_id, turn, {NULLED.format('role')}, {NULLED.format('text')} from conversations",
)
def _(spark, d):
    """Whole texts with line breaks, quotes and separators, written as CSV and read back."""
    table, path = A.load(spark, d, "conversations"), scratch(spark)
    table.write.mode("overwrite").csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return scan_csv(spark, path, table.schema, multi_line=True)


@query(
    "scan_events_by_day",
    """select event_id, event_type, cast(ts as date) as day from events
       where cast(ts as date) between date '2024-01-05' and date '2024-01-20'
         and event_type in ('click', 'view')""",
)
def _(spark, d):
    """The event table laid out by day, so that the range prunes folders."""
    path = scratch(spark)
    events = A.load(spark, d, "events").withColumn("day", F.to_date("ts"))
    write_full_refresh(events, path, ["day"])
    found = scan_events(
        spark, path, "2024-01-05", "2024-01-20", ["click", "view"], type_column="event_type"
    )
    return found.select("event_id", "event_type", "day")


def yearly_orders(spark, d):
    return A.load(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("survey_year")
    )


@query(
    "write_full_refresh",
    """select o_orderkey, o_totalprice, cast(year(o_orderdate) as integer) as survey_year
       from orders""",
)
def _(spark, d):
    """The whole table twice: the first time with other prices and a year of its own."""
    path, orders = scratch(spark), yearly_orders(spark, d)
    wrong = orders.withColumn("o_totalprice", -F.col("o_totalprice")).withColumn(
        "survey_year", F.col("survey_year") + 1
    )
    write_full_refresh(wrong, path, ["survey_year"])
    write_full_refresh(orders, path, ["survey_year"])
    return spark.read.parquet(path)


@query(
    "write_replace_years",
    """select o_orderkey, case when year(o_orderdate) = 1996 then 0.0::double
              else o_totalprice end as o_totalprice,
              cast(year(o_orderdate) as integer) as survey_year
       from orders where year(o_orderdate) <> 1997""",
)
def _(spark, d):
    """1996 gets other prices; 1997 is listed but has no new rows, so it ends up empty."""
    path, orders = scratch(spark), yearly_orders(spark, d)
    write_full_refresh(orders, path, ["survey_year"])
    new = orders.where("survey_year = 1996").withColumn("o_totalprice", F.lit(0.0))
    write_replace_years(new, path, [1996, 1997])
    return spark.read.parquet(path)


@query(
    "append_results",
    """select run_id, test_name, status, failure_count from log
       union all select run_id, test_name, 'pass', 0 from log where status = 'fail'""",
)
def _(spark, d):
    path, log = scratch(spark), A.check_log(spark, d)
    append_results(log, path)
    fixed = log.where("status = 'fail'").withColumns(
        {"status": F.lit("pass"), "failure_count": F.lit(0).cast("long")}
    )
    append_results(fixed, path)
    return spark.read.parquet(path).select("run_id", "test_name", "status", "failure_count")


@query(
    "scan_csv_split",
    f"select conv_id, turn, {NULLED.format('role')}, {NULLED.format('text')} from conversations",
)
def _(spark, d):
    """The texts of `scan_csv`, from files that are split whatever their cells hold."""
    table, path = A.load(spark, d, "conversations"), scratch(spark)
    table.write.csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return scan_csv(spark, path, table.schema, quoted_breaks=True)


@query(
    "scan_csv_rejected",
    """select cast(o_orderkey as varchar) as o_orderkey,
              case when o_orderkey % 7 = 0 then 'about ' || o_custkey
                   else cast(o_custkey as varchar) end as o_custkey,
              case when o_orderkey % 5 = 0 then 'soon' else cast(cast(o_orderdate as date) as varchar) end as o_orderdate,
              case when o_orderkey % 35 = 0 then 'o_custkey,o_orderdate'
                   when o_orderkey % 7 = 0 then 'o_custkey' else 'o_orderdate' end as misfits
       from orders where o_orderkey % 7 = 0 or o_orderkey % 5 = 0""",
)
def _(spark, d):
    """Orders with words where a number or a day should be: exactly these are given back."""
    path = scratch(spark)
    orders = A.load(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate")
    )
    odd = orders.select(
        F.col("o_orderkey").cast("string"),
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("about "), "o_custkey")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(F.col("o_orderkey") % 5 == 0, "soon").otherwise(F.col("o_orderdate").cast("string")).alias("o_orderdate"),
    )
    odd.write.csv(path, header=True, escape='"')
    found = scan_csv(spark, path, orders.schema, rejected=True)
    return found.withColumn("misfits", F.array_join("misfits", ","))


# headers of one survey that changed from year to year
YEAR_HEADERS = {
    0: {"response_id": "ResponseId", "ed_level": "EdLevel", "comp_total": "CompTotal"},
    1: {"ed_level": ' "EdLevel"', "response_id": "ResponseId", "years_code_pro": "YearsCodePro"},
    2: {"years_code_pro": "WorkExp", "response_id": '"ResponseId"', "language_have_worked_with": "LanguageHaveWorkedWith"},
}


@query(
    "load_survey_years",
    """with lists as (
           select response_id, survey_year,
                  string_agg(technology_name, ';' order by cast(substr(technology_name, 7) as integer)) as used
           from tech_a where is_currently_used and technology_category = 'language' group by all)
       select survey_year, response_id,
              case when survey_year % 3 < 2 then priority || chr(10) || 'of it' end as ed_level,
              case when survey_year % 3 = 0 then cast(cast(price as decimal(18, 2)) as varchar) end as comp_total,
              case when survey_year % 3 > 0 then cast(n_orders % 4 as varchar) end as years_code_pro,
              case when survey_year % 3 = 2 then used end as language_have_worked_with
       from people_a left join lists using (response_id, survey_year)""",
)
def _(spark, d):
    """A file a year, whose headers differ in name, order and number, and whose cells hold line
    breaks; one year's file is missing."""
    raw = cut_lineage(A.raw_survey_a(spark, d))
    raw = raw.withColumn("ed_level", F.concat("ed_level", F.lit("\nof it")))
    years = sorted(r[0] for r in raw.select("survey_year").distinct().collect())
    files = {2100: scratch(spark)}
    for year in years:
        headers = YEAR_HEADERS[year % 3]
        files[year] = scratch(spark)
        cells = [F.col(c).alias(h) for c, h in headers.items()] + [F.lit("x").alias("Unknown header")]
        raw.where(F.col("survey_year") == year).select(*cells).write.csv(files[year], header=True, escape='"')
    loaded = load_survey_years(spark, files)
    return loaded.select(
        "survey_year", "response_id", "ed_level", "comp_total", "years_code_pro", "language_have_worked_with"
    )


@query(
    "load_wide_survey_dotted",
    OPTIONS_SQL
    + """select response_id, cast(2022 as integer) as survey_year,
                'Brand#' || first_used as primary_language, used as languages_used,
                wanted as languages_plan_to_adopt, wanted as operating_systems
         from people_b left join o using (response_id)""",
)
def _(spark, d):
    """The files of 2021 and 2022: dotted headers, copies of options, answers that say none."""
    wide = A.wide_survey_b_dotted(spark, d)
    return load_wide_survey(wide, 2022).select(
        "response_id",
        "survey_year",
        "primary_language",
        "languages_used",
        "languages_plan_to_adopt",
        "operating_systems",
    )


@query(
    "append_results_run",
    """select l_linestatus, count(*) as runs, cast(sum(n) as bigint) as failure_count from (
           select l_linestatus, l_returnflag, count(*) as n from lineitem group by all) group by 1""",
)
def _(spark, d):
    """Results without a run get one of their own, the same for all rows of an append."""
    path, lines = scratch(spark), A.load(spark, d, "lineitem")
    for flag in ("A", "N", "R"):
        own = lines.where(F.col("l_returnflag") == flag)
        append_results(own.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n")), path)
    log = spark.read.parquet(path)
    return log.groupBy("l_linestatus").agg(
        F.count_distinct("run_id").alias("runs"), F.sum("n").alias("failure_count")
    )
