"""The derived tables."""

from pyspark.sql import functions as F

from devpulse import adapters as A
from devpulse.constants import NAME_MAPPING
from devpulse.functions import round_half_away
from devpulse.operators.aggregates import adoption_counts, exact_percentiles, respondent_totals
from devpulse.operators.aggregates import salary_stats, survey_average
from devpulse.operators.joins import join_respondent, join_spine
from devpulse.operators.reshape import technology_rows_a, unpivot_survey_a
from devpulse.operators.staging import stage_activity
from devpulse.operators.windows import dedup_mapping, year_median
from devpulse.plans.activity import yearly_activity
from devpulse.plans.anomalies import adoption_anomalies
from devpulse.plans.compare import said_vs_did
from devpulse.plans.dimension import dim_technologies
from devpulse.plans.salary import (
    filter_used,
    filter_valid_salary,
    paid_technologies_in_place,
    salary_by_stack,
)
from devpulse.plans.sentiment import technology_sentiment
from devpulse.plans.spine import mapping_seed, technologies, technology_spine
from devpulse.registry.base import query
from devpulse.sources.sinks import cut_lineage, materialize, scratch_table


def dims(spark):
    return technologies(A.spine(spark))


def stored(df):
    """A fact as the reports read it: a table, computed once however often it is used."""
    return cut_lineage(df)


def svd(spark, d):
    return said_vs_did(A.adoption(spark, d), dims(spark))


def salary(spark, d, dedupe=False):
    """Pay marts from surveys that have one row per respondent by construction."""
    surveys = A.staged_a(spark, d, profile=True)
    marts = salary_by_stack(surveys, None, A.spine(spark), dims(spark), dedupe)
    return marts.withColumn(
        "years_coding_professional", F.col("years_coding_professional").cast("long")
    )


def sentiment(spark, d):
    return technology_sentiment(A.yearly_a(spark, d), dims(spark))


def used_brands(spark, d):
    """A seed with repeats: every part's brand, mapped."""
    seed = A.brand_seed(spark)
    parts = A.load(spark, d, "part").select(F.col("p_brand").alias("source_name"))
    return parts.join(seed, "source_name").select(*seed.columns)


@query(
    "technology_spine",
    """select technology_id, source_name, canonical_name, technology_category,
              technology_subcategory from spine
       where source_name in (select p_brand from part)""",
)
def _(spark, d):
    return technology_spine(used_brands(spark, d))


@query(
    "dedup_mapping",
    """select p_name as source_name, min(p_brand) as canonical_name from part group by 1""",
)
def _(spark, d):
    pairs = A.load(spark, d, "part").select(
        F.col("p_name").alias("source_name"), F.col("p_brand").alias("canonical_name")
    )
    return dedup_mapping(pairs)


@query(
    "respondent_totals",
    """select survey_year, count(distinct response_id) as total_respondents
       from people_a group by 1""",
)
def _(spark, d):
    return respondent_totals(A.respondents_a(spark, d), A.NATURAL_KEY)


@query(
    "adoption_counts",
    """select survey_year, technology_name, technology_category, technology_subcategory,
              users_count, desired_count from yearly_a""",
)
def _(spark, d):
    rows = technology_rows_a(A.staged_a(spark, d), A.NATURAL_KEY)
    return adoption_counts(
        join_spine(rows, A.spine(spark), "technology_name"),
        {"users_count": "is_currently_used", "desired_count": "is_desired"},
        A.NATURAL_KEY,
    )


@query(
    "adoption_a",
    "select *, 'stackoverflow' as data_source from yearly_a",
)
def _(spark, d):
    return A.yearly_a(spark, d)


@query(
    "adoption_b",
    "select *, 'jetbrains' as data_source from yearly_b",
)
def _(spark, d):
    return A.yearly_b(spark, d)


def _rounded_stars(df):
    return df.withColumn("avg_stars", round_half_away(F.col("avg_stars"), 6))


@query(
    "yearly_activity",
    """select activity_year, technology_name, technology_category, technology_subcategory,
              total_events, total_unique_actors, total_unique_repos, total_commits,
              total_additions, total_deletions, round(avg_stars, 6) as avg_stars
       from yearly_g""",
)
def _(spark, d):
    return _rounded_stars(yearly_activity(stage_activity(A.raw_activity(spark, d)), A.spine(spark)))


@query(
    "activity_yearly",
    """select * replace (round(avg_stars, 6) as avg_stars), 'github' as data_source
       from yearly_g""",
)
def _(spark, d):
    return _rounded_stars(A.yearly_activity(spark, d))


@query("technology_adoption", "select * from adoption")
def _(spark, d):
    return A.adoption(spark, d)


@query(
    "dim_technologies",
    """select t.*, a.n is not null as in_stackoverflow, b.n is not null as in_jetbrains,
              g.n is not null as in_github,
              cast(a.n is not null as integer) + cast(b.n is not null as integer)
                  + cast(g.n is not null as integer) as source_coverage_count
       from techs t
       left join (select distinct technology_name as n from yearly_a) a on t.technology_name = a.n
       left join (select distinct technology_name as n from yearly_b) b on t.technology_name = b.n
       left join (select distinct technology_name as n from yearly_g) g on t.technology_name = g.n
    """,
)
def _(spark, d):
    return dim_technologies(
        A.spine(spark), *A.yearly_tables(spark, d, A.spine(spark))
    )


@query("said_vs_did", "select * from svd")
def _(spark, d):
    return svd(spark, d)


@query(
    "survey_average",
    """select year, technology_name, technology_category,
              avg(survey_adoption_pct) as avg_survey_adoption_pct,
              max(survey_desire_pct) as max_survey_desire_pct
       from adoption where survey_adoption_pct is not null group by all""",
)
def _(spark, d):
    return survey_average(A.adoption(spark, d), ["stackoverflow", "jetbrains"])


@query("technology_sentiment", "select * from sentiment")
def _(spark, d):
    return sentiment(spark, d)


@query("adoption_anomalies", "select * from anomaly")
def _(spark, d):
    return adoption_anomalies(A.adoption(spark, d))


@query("salary_by_stack", "select * from salary")
def _(spark, d):
    return salary(spark, d)


@query("salary_by_stack_joined", "select * from salary")
def _(spark, d):
    """The general route: technologies consolidated and joined back to their respondents."""
    surveys = A.staged_a(spark, d, profile=True)
    marts = salary_by_stack(surveys, unpivot_survey_a(surveys), A.spine(spark), dims(spark))
    return marts.withColumn(
        "years_coding_professional", F.col("years_coding_professional").cast("long")
    )


@query(
    "salary_by_stack_deduplicated",
    """with one as (
           select distinct p.survey_response_id, p.survey_year, s.canonical_name, country,
                  developer_roles, years_coding_professional, education_level, compensation_total
           from paid p join tech_a t on p.response_id = t.response_id
                and p.survey_year = t.survey_year and t.is_currently_used
           join spine s on t.technology_name = s.source_name)
       select survey_year, canonical_name as technology_name,
              cast(sum(respondent_count) as bigint) as respondents,
              cast(max(max_salary) as bigint) as max_salary
       from (select survey_year, canonical_name, country, developer_roles,
                    years_coding_professional, education_level, count(*) as respondent_count,
                    max(compensation_total) as max_salary from one group by all)
       group by all""",
)
def _(spark, d):
    groups = salary(spark, d, dedupe=True)
    return groups.groupBy("survey_year", "technology_name").agg(
        F.sum("respondent_count").alias("respondents"), F.max("max_salary").alias("max_salary")
    )


@query(
    "salary_stats",
    """select country, survey_year, count(*) as respondent_count,
              round(avg(compensation_total), 0) as avg_salary,
              round(quantile_cont(compensation_total, 0.5), 0) as median_salary,
              round(quantile_cont(compensation_total, 0.25), 0) as p25_salary,
              round(quantile_cont(compensation_total, 0.75), 0) as p75_salary,
              min(compensation_total) as min_salary, max(compensation_total) as max_salary
       from paid group by all""",
)
def _(spark, d):
    paid = filter_valid_salary(A.staged_a(spark, d, profile=True))
    return salary_stats(paid, ["country", "survey_year"])


@query(
    "year_median",
    """select survey_year, quantile_cont(compensation_total, 0.5) as median_pay
       from paid group by 1""",
)
def _(spark, d):
    paid = filter_valid_salary(A.staged_a(spark, d))
    paid = paid.withColumn("pay", F.col("compensation_total").cast("long"))
    return year_median(paid, "pay", "survey_year", "median_pay")


@query(
    "exact_percentiles",
    """select l_returnflag, round(quantile_cont(l_quantity, 0.1), 4) as p10,
              round(quantile_cont(l_quantity, 0.9), 4) as p90 from lineitem group by 1""",
)
def _(spark, d):
    lines = A.load(spark, d, "lineitem")
    points = exact_percentiles(lines, ["l_returnflag"], "l_quantity", {"p10": 0.1, "p90": 0.9})
    return points.select(
        "l_returnflag", *[round_half_away(F.col(c), 4).alias(c) for c in ("p10", "p90")]
    )


@query(
    "join_respondent_in_place",
    """select t.survey_year, t.technology_name, count(*) as paid_users,
              cast(sum(compensation_total) as bigint) as total_pay
       from paid p join tech_a t on p.response_id = t.response_id
            and p.survey_year = t.survey_year and t.is_currently_used group by all""",
)
def _(spark, d):
    people = paid_technologies_in_place(A.staged_a(spark, d, profile=True))
    return people.groupBy("survey_year", "technology_name").agg(
        F.count(F.lit(1)).alias("paid_users"),
        F.sum("compensation_total").cast("long").alias("total_pay"),
    )


@query(
    "materialize_view",
    """select survey_year, count(*) as technologies from yearly_a group by 1""",
)
def _(spark, d):
    published = materialize(A.yearly_a(spark, d), "devpulse_yearly_a")
    return published.groupBy("survey_year").agg(F.count(F.lit(1)).alias("technologies"))




def mapping_values() -> str:
    """The mapping as SQL values."""
    cells = [", ".join("'" + text.replace("'", "''") + "'" for text in row) for row in NAME_MAPPING]
    return ", ".join(f"({x})" for x in cells)


@query(
    "technology_mapping",
    f"""with seed_rows as (select * from (values {mapping_values()})
                           as v(source_name, canonical_name, technology_category, technology_subcategory)),
        one as (select * from seed_rows qualify row_number() over (
                    partition by source_name order by canonical_name, technology_category, technology_subcategory) = 1),
        names as (select row_number() over (order by source_name) - 1 as k, source_name
                  from (select distinct source_name from seed_rows))
        select s.canonical_name as technology_name, s.technology_category, s.technology_subcategory,
               md5(s.canonical_name || '-' || s.technology_category) as technology_id,
               count(*) as parts, cast(sum(p_size) as bigint) as total_size
        from part join names on p_partkey % 100 = k join one s on names.source_name = s.source_name
        group by all""",
)
def _(spark, d):
    """The whole mapping, repeated names and all: every part says one of its names, or none."""
    names = sorted({row[0] for row in NAME_MAPPING})
    parts = A.load(spark, d, "part")
    said = F.get(F.array(*map(F.lit, names)), (F.col("p_partkey") % 100).cast("int"))
    rows = parts.select(said.alias("technology_name"), "p_size").where("technology_name IS NOT NULL")
    spine = technology_spine(mapping_seed(spark))
    mapped = join_spine(rows, spine, "technology_name")
    known = technologies(spine).select("technology_name", "technology_id")
    return (
        mapped.join(known, "technology_name")
        .groupBy("technology_name", "technology_category", "technology_subcategory", "technology_id")
        .agg(F.count(F.lit(1)).alias("parts"), F.sum("p_size").cast("long").alias("total_size"))
    )


@query(
    "pay_join_bucketed",
    """select p.survey_year, t.technology_name, count(*) as people,
              cast(sum(compensation_total) as bigint) as total_pay
       from paid p join tech_a t on p.response_id = t.response_id and p.survey_year = t.survey_year
            and t.is_currently_used group by 1, 2""",
)
def _(spark, d):
    """Surveys and their consolidated technologies as tables in equal buckets of the natural key:
    respondents meet their technologies without a shuffle.  There are as many buckets as partitions
    by that key, so each task writes one file of one bucket."""
    buckets = A.respondent_parts(spark, d)
    orders = cut_lineage(A.order_sets(spark, d))
    surveys = A.staged_a(spark, d, profile=True, orders=orders)
    technologies = unpivot_survey_a(A.staged_a(spark, d, orders=orders), A.NATURAL_KEY)
    paid = filter_valid_salary(surveys).repartition(buckets, *A.NATURAL_KEY)
    paid = scratch_table(paid, A.NATURAL_KEY, buckets)
    used = scratch_table(filter_used(technologies), A.NATURAL_KEY, buckets)
    joined = join_respondent(paid, used, A.NATURAL_KEY)
    return joined.groupBy("survey_year", "technology_name").agg(
        F.count(F.lit(1)).alias("people"), F.sum("compensation_total").cast("long").alias("total_pay")
    )
