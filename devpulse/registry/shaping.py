"""Projections, filters, list explosion, set operations and scalar functions."""

from pyspark.sql import functions as F

from devpulse import adapters as A
from devpulse import functions as fn
from devpulse.operators.aggregates import filter_domains, filter_sources
from devpulse.operators.joins import presence_flags
from devpulse.operators.reshape import (
    explode_multiselect,
    or_flags,
    pivot_years,
    technology_rows_a,
    unpivot_survey_a,
    unpivot_survey_b,
)
from devpulse.operators.roles import explode_skills, label_roles, role_counts
from devpulse.operators.staging import stage_activity
from devpulse.plans.adoption import align_typed_nulls
from devpulse.plans.salary import filter_used, filter_valid_salary
from devpulse.registry.base import query
from devpulse.reporting.reports import adoption_series
from devpulse.sources.activity import extract_event_fields, monthly_events

ACCEPTED = ["PushEvent", "PullRequestEvent", "IssuesEvent", "WatchEvent"]


@query(
    "stage_survey_a",
    """with lists as (
           select response_id, survey_year,
                  string_agg(p_brand, ';' order by bn) filter (where used and bn % 4 = 0)
                      as languages_used,
                  string_agg(p_brand, ';' order by bn) filter (where desired and bn % 4 = 2)
                      as platforms_desired
           from (select cast(o_custkey as varchar) as response_id,
                        cast(year(o_orderdate) as integer) as survey_year, p_brand, bn,
                        bool_or(used) as used, bool_or(desired) as desired
                 from mention join orders on l_orderkey = o_orderkey group by all)
           group by all)
       select md5(response_id || '-' || survey_year) as survey_response_id, response_id,
              survey_year, priority as education_level, n_orders as years_coding_total,
              n_orders % 4 as years_coding_professional,
              cast(round(price, 0) as bigint) as compensation_total,
              case when priority = '3-MEDIUM' then 'Monthly' else 'Yearly' end
                  as compensation_frequency,
              languages_used, platforms_desired
       from people_a left join lists using (response_id, survey_year)""",
)
def _(spark, d):
    whole = ["years_coding_total", "years_coding_professional", "compensation_total"]
    staged = A.staged_a(spark, d)
    return staged.select(
        "survey_response_id",
        "response_id",
        "survey_year",
        "education_level",
        *[F.col(c).cast("long").alias(c) for c in whole],
        "compensation_frequency",
        "languages_used",
        "platforms_desired",
    )


@query(
    "stage_survey_b",
    """select md5(response_id || '-' || survey_year) as survey_response_id, response_id,
              survey_year, first_brand as primary_language, frameworks_used
       from (select *, null::varchar as frameworks_used from people_b) left join (
           select l_orderkey as o_orderkey, 'Brand#' || min(bn) as first_brand
           from mention where used group by 1) using (o_orderkey)""",
)
def _(spark, d):
    return A.staged_b(spark, d).select(
        "survey_response_id", "response_id", "survey_year", "primary_language", "frameworks_used"
    )


@query(
    "stage_activity",
    """select md5(activity_month || '-' || repo_language || '-' || event_type) as activity_id,
              activity_month, cast(date_trunc('year', activity_month) as date) as activity_year,
              repo_language, event_type, event_count, unique_actors, unique_repos,
              total_commits, total_additions, total_deletions,
              round(avg_repo_stars, 6) as avg_repo_stars
       from monthly where event_count > 0""",
)
def _(spark, d):
    staged = stage_activity(A.raw_activity(spark, d)).drop("_loaded_at")
    stars = fn.round_half_away(F.col("avg_repo_stars"), 6)
    return staged.withColumn("avg_repo_stars", stars)


@query(
    "extract_event_fields",
    """select event_id, cast(date_trunc('month', ts) as date) as activity_month,
              type as event_type,
              case when k % 10 <> 0 then 'Brand#' || (k % 25 + 1) else 'Unknown' end
                  as repo_language,
              'repo' || k as repo_name, cast(user_id as varchar) as actor_login,
              cast(case when type = 'PushEvent' then k % 4 else 0 end as bigint) as commit_count
       from archive""",
)
def _(spark, d):
    events = A.archive_events(spark, d)
    # the id travels inside the repository name, as the operator keeps only its own columns
    tagged = events.withColumn(
        "repo",
        F.struct(
            F.concat_ws("|", F.col("repo.name"), F.col("event_id").cast("string")).alias("name")
        ),
    )
    fields = extract_event_fields(tagged)
    parts = F.split("repo_name", "\\|")
    return fields.select(
        parts[1].cast("long").alias("event_id"),
        "activity_month",
        "event_type",
        "repo_language",
        parts[0].alias("repo_name"),
        "actor_login",
        "commit_count",
    )


@query(
    "monthly_events",
    """select cast(date_trunc('day', ts) as date) as activity_month,
              case when k % 10 <> 0 then 'Brand#' || (k % 25 + 1) else 'Unknown' end
                  as repo_language,
              type as event_type, count(*) as event_count,
              count(distinct user_id) as unique_actors, count(distinct k) as unique_repos,
              cast(sum(case when type = 'PushEvent' then k % 4 else 0 end) as bigint)
                  as total_commits
       from archive where type in
           ('PushEvent', 'PullRequestEvent', 'IssuesEvent', 'WatchEvent')
       group by 1, 2, 3 having count(*) >= 5""",
)
def _(spark, d):
    accepted = A.archive_events(spark, d).where(F.col("type").isin(ACCEPTED))
    return monthly_events(extract_event_fields(accepted, unit="day"), min_count=5)


@query(
    "filter_valid_salary",
    """select survey_response_id, compensation_total, country from paid""",
)
def _(spark, d):
    paid = filter_valid_salary(A.staged_a(spark, d, profile=True))
    return paid.select(
        "survey_response_id",
        F.col("compensation_total").cast("long").alias("compensation_total"),
        "country",
    )


@query(
    "filter_used",
    """select survey_year, technology_name, technology_category, count(*) as users
       from tech_a where is_currently_used group by all""",
)
def _(spark, d):
    used = filter_used(unpivot_survey_a(A.staged_a(spark, d)))
    return used.groupBy("survey_year", "technology_name", "technology_category").agg(
        F.count(F.lit(1)).alias("users")
    )


@query(
    "filter_sources",
    """select year, technology_name, data_source, survey_desire_pct from adoption
       where data_source in ('stackoverflow', 'jetbrains') and survey_desire_pct is not null""",
)
def _(spark, d):
    rows = filter_sources(
        A.adoption(spark, d), ["stackoverflow", "jetbrains"], "survey_desire_pct"
    )
    return rows.select("year", "technology_name", "data_source", "survey_desire_pct")


@query(
    "filter_domains",
    "select distinct p_type from part where p_type is not null",
)
def _(spark, d):
    return filter_domains(A.load(spark, d, "part"), "p_type")


@query(
    "presence_flags",
    """select d.doc_id, quality is not null as has_quality, n_chars is not null as has_size,
              cast(quality is not null as integer) + cast(n_chars is not null as integer)
                  as coverage
       from documents d left join labels l on d.doc_id = l.doc_id""",
)
def _(spark, d):
    docs = A.load(spark, d, "documents").join(A.load(spark, d, "labels"), "doc_id", "left")
    flags = {"quality": "has_quality", "n_chars": "has_size"}
    return presence_flags(docs, flags, "coverage").select(
        "doc_id", "has_quality", "has_size", "coverage"
    )


@query(
    "align_typed_nulls",
    """select survey_year as year, technology_name, technology_category,
              'jetbrains' as data_source, null::double as survey_adoption_pct,
              null::double as survey_desire_pct, users_count, total_respondents,
              null::double as github_event_share, null::double as github_actor_share,
              null::bigint as github_total_events, null::bigint as github_unique_actors,
              null::bigint as github_unique_repos from yearly_b""",
)
def _(spark, d):
    return align_typed_nulls(A.yearly_b(spark, d).withColumnRenamed("survey_year", "year"))


@query(
    "label_roles",
    """select survey_response_id, role from profile, (values
           ('Data engineer', 'data engineer'), ('Data engineer', 'engineer, data'),
           ('Data scientist / ML', 'data scientist'), ('Data scientist / ML', 'ai/ml engineer'),
           ('Data / Business analyst', 'data or business analyst'),
           ('Database administrator', 'database administrator')) r(role, alias)
       where contains(lower(developer_roles), alias)""",
)
def _(spark, d):
    people = A.staged_a(spark, d, profile=True)
    return label_roles(people, column="developer_roles").select("survey_response_id", "role")


@query(
    "role_counts",
    """select role, count(*) as respondents from profile, (values
           ('Data engineer', 'data engineer'), ('Data scientist / ML', 'data scientist'),
           ('Data / Business analyst', 'data or business analyst'),
           ('Database administrator', 'database administrator')) r(role, alias)
       where contains(lower(developer_roles), alias) group by 1""",
)
def _(spark, d):
    return role_counts(label_roles(A.raw_survey_a(spark, d, profile=True)))


@query(
    "explode_multiselect",
    """select distinct cast(o_custkey as varchar) as response_id,
              cast(year(o_orderdate) as integer) as survey_year, p_brand as technology_name
       from mention join orders on l_orderkey = o_orderkey where used and bn % 4 = 1""",
)
def _(spark, d):
    rows = explode_multiselect(A.staged_a(spark, d), "databases_used")
    return rows.select("response_id", "survey_year", "technology_name")


@query(
    "explode_multiselect_text",
    """select doc_id, trim(part) as part, count(*) as occurrences
       from (select doc_id, unnest(string_split(text, '. ')) as part from documents)
       where trim(part) <> '' group by all""",
)
def _(spark, d):
    docs = A.load(spark, d, "documents")
    parts = explode_multiselect(docs, "text", separator=". ", name="part")
    return parts.groupBy("doc_id", "part").agg(F.count(F.lit(1)).alias("occurrences"))


@query(
    "explode_skills",
    """select role_text, trim(skill) as skill, count(*) as listed from (
           select developer_roles as role_text, unnest(string_split(developer_roles, ';')) as skill
           from profile) group by all""",
)
def _(spark, d):
    people = A.staged_a(spark, d, profile=True)
    rows = explode_skills(people, "developer_roles")
    return rows.groupBy(F.col("developer_roles").alias("role_text"), "skill").agg(
        F.count(F.lit(1)).alias("listed")
    )


@query(
    "unpivot_survey_a",
    """select md5(response_id || '-' || survey_year) as survey_response_id, survey_year,
              technology_name, technology_category, is_currently_used, is_desired from tech_a""",
)
def _(spark, d):
    return unpivot_survey_a(A.staged_a(spark, d))


@query(
    "unpivot_survey_b",
    """select md5(response_id || '-' || survey_year) as survey_response_id, survey_year,
              technology_name, technology_category, is_currently_used, is_primary from tech_b""",
)
def _(spark, d):
    return unpivot_survey_b(A.staged_b(spark, d))


@query(
    "or_flags",
    """select survey_year, technology_name, bool_or(is_currently_used) as is_currently_used,
              bool_or(is_desired) as is_desired from tech_a group by all""",
)
def _(spark, d):
    rows = technology_rows_a(A.staged_a(spark, d))
    return or_flags(rows, ["survey_year", "technology_name"], ["is_currently_used", "is_desired"])


@query(
    "pivot_years",
    """select technology_name,
              round(avg(survey_adoption_pct) filter (where year = 1995), 1) as y1995,
              round(avg(survey_adoption_pct) filter (where year = 1996), 1) as y1996,
              round(avg(survey_adoption_pct) filter (where year = 1997), 1) as y1997,
              round(avg(survey_adoption_pct) filter (where year = 1998), 1) as y1998,
              round(avg(survey_adoption_pct) filter (where year = 1999), 1) as y1999,
              round(avg(survey_adoption_pct) filter (where year = 2000), 1) as y2000,
              round(avg(survey_adoption_pct) filter (where year = 2001), 1) as y2001
       from series group by 1""",
)
def _(spark, d):
    series = adoption_series(A.adoption(spark, d))
    return pivot_years(series, range(1995, 2002), "survey_adoption_pct")


@query(
    "union_all",
    """select 'order' as kind, o_orderkey as id, o_orderdate as at from orders
       union all select 'line', l_orderkey, l_shipdate from lineitem""",
)
def _(spark, d):
    orders = A.load(spark, d, "orders").select(
        F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at")
    )
    lines = A.load(spark, d, "lineitem").select(
        F.lit("line").alias("kind"), F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("at")
    )
    return orders.unionByName(lines)


# --- scalar functions ----------------------------------------------------------


@query(
    "text_functions",
    """select page_id, trim(url) as trimmed, lower(url) as lowered,
              lower(url) like '%/en/%' as english,
              'page ' || page_id || ' of ' || length(url) as sentence,
              regexp_matches(url, '\\s+[0-9]+') as spaced_number,
              regexp_extract(url, '^https?://([^/]+)/', 1) as host,
              starts_with(url, 'https') as secure
       from pages""",
)
def _(spark, d):
    url = F.col("url")
    return A.load(spark, d, "pages").select(
        "page_id",
        F.trim(url).alias("trimmed"),
        F.lower(url).alias("lowered"),
        fn.contains_any(url, ["/EN/"]).alias("english"),
        F.concat(
            F.lit("page "),
            F.col("page_id").cast("string"),
            F.lit(" of "),
            F.length(url).cast("string"),
        ).alias("sentence"),
        url.rlike(r"\s+[0-9]+").alias("spaced_number"),
        F.regexp_extract(url, "^https?://([^/]+)/", 1).alias("host"),
        url.startswith("https").alias("secure"),
    )


@query(
    "number_functions",
    """select o_orderkey,
              cast(round(o_totalprice, 0) as bigint) as whole_price,
              try_cast(o_orderpriority as bigint) as no_number,
              round(o_totalprice / 7, 2) as seventh,
              abs(o_totalprice - 250000) as distance,
              greatest(0.4, least(1.0, o_totalprice / 500000)) as clamped,
              o_totalprice / nullif(case when o_orderstatus = 'P' then 0 else 3 end, 0)::double
                  as divided,
              coalesce(nullif(o_orderstatus, 'P'), '?') as filled
       from orders""",
)
def _(spark, d):
    price = F.col("o_totalprice")
    text = price.cast("decimal(18,2)").cast("string")
    zero_or_three = F.when(F.col("o_orderstatus") == "P", 0).otherwise(3)
    return A.load(spark, d, "orders").select(
        "o_orderkey",
        fn.to_whole_number(text).cast("long").alias("whole_price"),
        fn.to_whole_number(F.col("o_orderpriority")).cast("long").alias("no_number"),
        fn.round_half_away(price / 7, 2).alias("seventh"),
        F.abs(price - 250000).alias("distance"),
        fn.clamp(price / 500000, 0.4, 1.0).alias("clamped"),
        fn.ratio(price, zero_or_three).alias("divided"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")), F.lit("?")).alias("filled"),
    )


@query(
    "pct_of_total",
    """select p_brand, (n * 20000 + t) // (2 * t) / 100.0::double as pct from (
           select p_brand, count(*) filter (where p_size <= 7) as n, count(*) as t
           from part group by 1)""",
)
def _(spark, d):
    brands = A.load(spark, d, "part").groupBy("p_brand").agg(
        F.count_if(F.col("p_size") <= 7).alias("n"), F.count(F.lit(1)).alias("t")
    )
    return brands.select("p_brand", fn.pct_of_total(F.col("n"), F.col("t")).alias("pct"))


@query(
    "date_functions",
    """select event_id, cast(date_trunc('month', ts) as date) as month,
              cast(year(ts) as integer) as year,
              cast(date_diff('hour', ts, timestamp '2024-02-02 12:30:00') as integer) as hours,
              cast(date_diff('day', ts, timestamp '2024-02-02 12:30:00') as integer) as days
       from events""",
)
def _(spark, d):
    as_of = F.lit("2024-02-02 12:30:00").cast("timestamp_ntz")
    return A.load(spark, d, "events").select(
        "event_id",
        F.trunc("ts", "month").alias("month"),
        F.year("ts").alias("year"),
        fn.hours_between(F.col("ts"), as_of).alias("hours"),
        fn.days_between(F.col("ts"), as_of).alias("days"),
    )


@query(
    "surrogate_key",
    """select d.doc_id,
              md5(coalesce(d.source, '_dbt_utils_surrogate_key_null_') || '-' ||
                  coalesce(cast(l.quality as varchar), '_dbt_utils_surrogate_key_null_')) as key
       from documents d left join labels l on d.doc_id = l.doc_id""",
)
def _(spark, d):
    docs = A.load(spark, d, "documents").join(A.load(spark, d, "labels"), "doc_id", "left")
    return docs.select("doc_id", fn.surrogate_key("source", "quality").alias("key"))


@query(
    "json_functions",
    """select event_id, json_extract_string(props, '$.k') as k,
              cast(json_array_length('[' || json_extract_string(props, '$.k') || ',1]') as integer)
                  as length
       from events""",
)
def _(spark, d):
    k = F.get_json_object("props", "$.k")
    pair = F.concat(F.lit("["), k, F.lit(",1]"))
    return A.load(spark, d, "events").select(
        "event_id", k.alias("k"), F.json_array_length(pair).alias("length")
    )


@query(
    "ordered_text",
    """select p_brand, string_agg(p_type || ' ' || n, ', ' order by p_type) as types from (
           select p_brand, p_type, count(*) as n from part group by all) group by 1""",
)
def _(spark, d):
    counts = A.load(spark, d, "part").groupBy("p_brand", "p_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    text = F.concat_ws(" ", F.col("p_type"), F.col("n").cast("string"))
    return counts.groupBy("p_brand").agg(fn.ordered_text(F.col("p_type"), text).alias("types"))
