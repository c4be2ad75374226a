"""Joins, grouped aggregates, windows and orders."""

from pyspark.sql import functions as F

from devpulse import adapters as A
from devpulse.functions import round_half_away
from devpulse.operators import joins as J
from devpulse.operators import ordering as O
from devpulse.operators.aggregates import (
    count_where,
    distinct_names,
    groups_having,
    mean_over_sources,
    respondent_totals,
    top_n_by_mean,
)
from devpulse.operators.reshape import unpivot_survey_a
from devpulse.operators.roles import top_per
from devpulse.operators.windows import (
    yoy_prior,
    share_of_year,
    trailing_stats,
    yoy_abs_by_source,
    yoy_delta,
)
from devpulse.plans.spine import technologies
from devpulse.quality.dashboard import full_outer_health, latest_run
from devpulse.registry.base import query


def yearly_prices(spark, d):
    """Orders per year and priority: a small yearly series for the window operators."""
    return (
        A.load(spark, d, "orders")
        .groupBy(
            F.year("o_orderdate").alias("year"),
            F.col("o_orderpriority").alias("technology_name"),
            F.col("o_orderstatus").alias("data_source"),
        )
        .agg(
            (F.count(F.lit(1)) / 10).alias("survey_adoption_pct"),
            F.count(F.lit(1)).alias("orders"),
        )
    )


PRICES = """
    select cast(year(o_orderdate) as integer) as year, o_orderpriority as technology_name,
           o_orderstatus as data_source, count(*) / 10.0::double as survey_adoption_pct,
           count(*) as orders
    from orders group by all"""


@query(
    "join_spine",
    """select l_orderkey, l_linenumber, s.canonical_name as technology_name,
              s.technology_category, s.technology_subcategory
       from lineitem join part on l_partkey = p_partkey join spine s on p_brand = s.source_name""",
)
def _(spark, d):
    lines = A.load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = A.load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    named = lines.join(parts, "l_partkey").drop("l_partkey")
    return J.join_spine(named, A.spine(spark), "p_brand")


@query(
    "join_year_totals",
    """select survey_year, response_id, total_respondents from people_b
       join (select survey_year, count(distinct response_id) as total_respondents
             from people_b group by 1) using (survey_year)""",
)
def _(spark, d):
    people = A.respondents_b(spark, d)
    return J.join_year_totals(people, respondent_totals(people, A.NATURAL_KEY))


@query(
    "join_respondent",
    """select survey_year, response_id, n_orders, technology_name, is_currently_used
       from (select response_id, survey_year, n_orders from people_a)
       join tech_a using (response_id, survey_year)""",
)
def _(spark, d):
    # both sides in the same partitions, of about as many orders at any size
    people = A.respondents_a(spark, d).repartition(A.respondent_parts(spark, d), *A.NATURAL_KEY)
    people = people.groupBy(*A.NATURAL_KEY).agg(F.count(F.lit(1)).alias("n_orders"))
    technologies = unpivot_survey_a(A.staged_a(spark, d), A.NATURAL_KEY)
    return J.join_respondent(people, technologies, A.NATURAL_KEY).select(
        "survey_year", "response_id", "n_orders", "technology_name", "is_currently_used"
    )


@query(
    "join_dim",
    """select o_orderkey, c_name, c_mktsegment from orders
       left join customer on o_custkey = c_custkey""",
)
def _(spark, d):
    orders = A.load(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("technology_name")
    )
    dim = A.load(spark, d, "customer").withColumnRenamed("c_custkey", "technology_name")
    return J.join_dim(orders, dim, ["c_name", "c_mktsegment"]).drop("technology_name")


@query(
    "join_presence",
    """select c_custkey, exists (select 1 from orders where o_custkey = c_custkey
                  and o_orderstatus = 'F') as has_finished,
              exists (select 1 from orders where o_custkey = c_custkey
                  and o_orderpriority = '1-URGENT') as has_urgent
       from customer""",
)
def _(spark, d):
    orders = A.load(spark, d, "orders").withColumnRenamed("o_custkey", "technology_name")
    names = A.load(spark, d, "customer").select("c_custkey")
    sources = {
        "has_finished": orders.where(F.col("o_orderstatus") == "F"),
        "has_urgent": orders.where(F.col("o_orderpriority") == "1-URGENT"),
    }
    return J.join_presence(names, sources, "c_custkey")


@query(
    "full_outer_compare",
    """select coalesce(a.doc_id, b.doc_id) as doc_id, n_chars, quality
       from (select doc_id, n_chars from documents) a
       full join (select doc_id, quality from labels) b on a.doc_id = b.doc_id""",
)
def _(spark, d):
    docs = A.load(spark, d, "documents")
    labels = A.load(spark, d, "labels").select("doc_id", "quality")
    return J.full_outer_compare(docs.select("doc_id", "n_chars"), labels, ["doc_id"])


@query(
    "full_outer_health",
    """select coalesce(a.model_name, b.model_name) as model_name, tests, hours_since_load
       from (select source as model_name, count(*) as tests from documents group by 1) a
       full join (select 'src' || (l_suppkey % 30) as model_name,
                         max(l_orderkey) as hours_since_load from lineitem group by 1) b
         on a.model_name = b.model_name""",
)
def _(spark, d):
    docs = A.load(spark, d, "documents")
    tests = docs.groupBy(F.col("source").alias("model_name")).agg(
        F.count(F.lit(1)).alias("tests")
    )
    model = F.concat(F.lit("src"), (F.col("l_suppkey") % 30).cast("string"))
    loads = A.load(spark, d, "lineitem").groupBy(model.alias("model_name")).agg(
        F.max("l_orderkey").alias("hours_since_load")
    )
    return full_outer_health(tests, loads)


@query(
    "latest_run",
    """select test_name, status, run_at from log where run_at = (select max(run_at) from log)""",
)
def _(spark, d):
    return latest_run(A.check_log(spark, d)).select("test_name", "status", "run_at")


@query(
    "latest_year_rows",
    """select event_id, ts from events
       where cast(ts as date) = (select max(cast(ts as date)) from events)""",
)
def _(spark, d):
    events = A.load(spark, d, "events").withColumn("day", F.to_date("ts"))
    return J.latest_year_rows(events, "day").select("event_id", "ts")


@query(
    "cross_expected",
    """select distinct c_nationkey, s.source from customer,
              (values ('x'), ('y'), ('z')) s(source)""",
)
def _(spark, d):
    return J.cross_expected(A.load(spark, d, "customer"), "c_nationkey", ["x", "y", "z"], "source")


@query(
    "anti_missing",
    """select c_custkey from customer
       where not exists (select 1 from orders where o_custkey = c_custkey
                         and o_totalprice > 400000)""",
)
def _(spark, d):
    large = A.load(spark, d, "orders").where(F.col("o_totalprice") > 400000)
    names = A.load(spark, d, "customer").select("c_custkey")
    return J.anti_missing(names, large.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


@query(
    "keep_top",
    """select o_orderkey, o_custkey from orders where o_custkey in (
           select o_custkey from orders group by 1
           order by avg(o_totalprice) desc, 1 limit 20)""",
)
def _(spark, d):
    orders = A.load(spark, d, "orders")
    top = top_n_by_mean(orders, 20, "o_totalprice", "o_custkey")
    return J.keep_top(orders, top, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query(
    "distinct_names",
    "select distinct technology_id, technology_name, technology_category, technology_subcategory "
    "from techs where technology_name in (select canonical_name from spine "
    "join part on source_name = p_brand)",
)
def _(spark, d):
    brands = A.load(spark, d, "part").select(F.col("p_brand").alias("source_name"))
    known = A.spine(spark).join(brands, "source_name", "left_semi")
    return distinct_names(
        technologies(known),
        ["technology_id", "technology_name", "technology_category", "technology_subcategory"],
    )


@query(
    "count_where",
    """select l_returnflag, count(*) filter (where l_discount > 0.05) as discounted,
              count(*) filter (where l_linestatus = 'F') as finished
       from lineitem group by 1""",
)
def _(spark, d):
    return A.load(spark, d, "lineitem").groupBy("l_returnflag").agg(
        count_where(F.col("l_discount") > 0.05).alias("discounted"),
        count_where(F.col("l_linestatus") == "F").alias("finished"),
    )


@query(
    "groups_having",
    """select l_partkey, l_suppkey, count(*) as row_count from lineitem
       group by all having count(*) >= 2""",
)
def _(spark, d):
    return groups_having(A.load(spark, d, "lineitem"), ["l_partkey", "l_suppkey"])


@query("mean_over_sources", "select * from series")
def _(spark, d):
    rows = A.adoption(spark, d).where(F.col("survey_adoption_pct").isNotNull())
    return mean_over_sources(rows)


@query(
    "top_n_by_mean",
    """select technology_name, round(avg(survey_adoption_pct), 6) as mean_value from series
       group by 1 order by avg(survey_adoption_pct) desc, 1 limit 5""",
)
def _(spark, d):
    rows = A.adoption(spark, d).where(F.col("survey_adoption_pct").isNotNull())
    top = top_n_by_mean(mean_over_sources(rows), 5)
    return top.withColumn("mean_value", round_half_away(F.col("mean_value"), 6))


# --- windows -------------------------------------------------------------------


@query(
    "share_of_year",
    f"""select year, technology_name, data_source,
               orders / sum(orders) over (partition by year)::double as share
        from ({PRICES})""",
)
def _(spark, d):
    shared = share_of_year(yearly_prices(spark, d), {"share": "orders"}, "year")
    return shared.select("year", "technology_name", "data_source", "share")


@query(
    "yoy_delta",
    f"""select year, technology_name, data_source,
               survey_adoption_pct - lag(survey_adoption_pct) over
                   (partition by technology_name, data_source order by year) as delta
        from ({PRICES})""",
)
def _(spark, d):
    delta = yoy_delta("survey_adoption_pct", ["technology_name", "data_source"])
    return yearly_prices(spark, d).select(
        "year", "technology_name", "data_source", delta.alias("delta")
    )


@query(
    "yoy_prior",
    f"""select year, technology_name, data_source, lag(survey_adoption_pct) over
                   (partition by technology_name, data_source order by year) as prior
        from ({PRICES})""",
)
def _(spark, d):
    prior = yoy_prior("survey_adoption_pct", ["technology_name", "data_source"])
    return yearly_prices(spark, d).select(
        "year", "technology_name", "data_source", prior.alias("prior")
    )


@query(
    "yoy_abs_by_source",
    f"""select *, abs(survey_adoption_pct - prior_year_pct) as yoy_change_abs from (
            select *, lag(survey_adoption_pct) over
                   (partition by technology_name, data_source order by year) as prior_year_pct
            from ({PRICES}))""",
)
def _(spark, d):
    return yoy_abs_by_source(yearly_prices(spark, d))


@query(
    "trailing_stats",
    f"""select year, technology_name, data_source, round(avg(survey_adoption_pct) over r, 6)
                   as trailing_avg,
               round(stddev_samp(survey_adoption_pct) over r, 6) as trailing_stddev,
               count(*) over (partition by technology_name, data_source order by year
                   rows between unbounded preceding and 1 preceding) as prior_years_count
        from ({PRICES})
        window r as (partition by technology_name, data_source order by year
                     rows between 2 preceding and 1 preceding)""",
)
def _(spark, d):
    stats = trailing_stats(yearly_prices(spark, d), "survey_adoption_pct")
    return stats.select(
        "year",
        "technology_name",
        "data_source",
        round_half_away(F.col("trailing_avg"), 6).alias("trailing_avg"),
        round_half_away(F.col("trailing_stddev"), 6).alias("trailing_stddev"),
        "prior_years_count",
    )


# --- orders --------------------------------------------------------------------


@query(
    "order_by_rank",
    """select o_orderkey, o_orderpriority from orders order by
           case o_orderpriority when '5-LOW' then 1 when '1-URGENT' then 2 else 3 end, o_orderkey""",
)
def _(spark, d):
    orders = A.load(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    ranks = ["5-LOW", "1-URGENT"]
    return O.order_by_rank(orders, "o_orderpriority", ranks, ["o_orderkey"])


@query(
    "order_by_abs",
    """select o_orderkey, o_totalprice - 250000 as distance from orders
       order by abs(o_totalprice - 250000) desc, o_orderkey""",
)
def _(spark, d):
    rows = A.load(spark, d, "orders").select(
        "o_orderkey", (F.col("o_totalprice") - 250000).alias("distance")
    )
    return O.order_by_abs(rows, "distance", [F.asc("o_orderkey")])


@query(
    "top_k",
    """select l_orderkey, l_linenumber, l_extendedprice from lineitem
       order by l_extendedprice desc, l_orderkey, l_linenumber limit 25""",
)
def _(spark, d):
    lines = A.load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    return O.top_k(lines, order, 25)


@query(
    "top_per",
    """select o_orderpriority, o_orderkey, o_totalprice from (
           select *, row_number() over (partition by o_orderpriority
               order by o_totalprice desc, o_orderkey) as r from orders) where r <= 5""",
)
def _(spark, d):
    orders = A.load(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return top_per(orders, ["o_orderpriority"], order, 5)


@query(
    "row_at_max",
    """select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 1""",
)
def _(spark, d):
    orders = A.load(spark, d, "orders")
    return O.row_at_max(orders, "o_totalprice", ["o_orderkey", "o_totalprice"], "o_orderkey")


@query(
    "first_last",
    """select first(p_name order by p_retailprice desc, p_name) as top_p_name,
              max(p_retailprice) as top_p_retailprice,
              last(p_name order by p_retailprice desc, p_name) as bottom_p_name,
              min(p_retailprice) as bottom_p_retailprice from part""",
)
def _(spark, d):
    return O.first_last(A.load(spark, d, "part"), "p_retailprice", "p_name")


@query(
    "sort_keys",
    """select o_orderpriority, o_orderstatus, count(*) as orders from orders group by all""",
)
def _(spark, d):
    counts = A.load(spark, d, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders")
    )
    return O.sort_keys(counts, ["o_orderpriority", "o_orderstatus"])
