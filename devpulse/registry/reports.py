"""Report queries over the facts."""

from pyspark.sql import functions as F

from devpulse import adapters as A
from devpulse.functions import round_half_away
from devpulse.registry import marts as M
from devpulse.registry.base import query
from devpulse.reporting import reports as R

SKILL = "language_have_worked_with"
ROLES = """
    (values ('Data engineer', 'data engineer'), ('Data scientist / ML', 'data scientist'),
            ('Data / Business analyst', 'data or business analyst'),
            ('Database administrator', 'database administrator')) r(role, alias)"""
SKILLS = f"""
    with labelled as (
        select response_id, survey_year, role from profile, {ROLES}
        where contains(lower(developer_roles), alias)),
    listed as (
        select l.*, t.technology_name as skill from labelled l
        join tech_a t using (response_id, survey_year)
        where t.is_currently_used and t.technology_category = 'language'),
    shares as (
        select role, skill, count(*) as skill_count,
               round(count(*) / any_value(answered) * 100, 1) as pct
        from listed join (select role, count(distinct (response_id, survey_year)) as answered
                          from listed group by 1) using (role) group by 1, 2),
    yearly as (
        select survey_year, skill, skill_count, pct from (
            select survey_year, skill, count(*) as skill_count,
                   round(count(*) / any_value(answered) * 100, 1) as pct,
                   row_number() over (partition by survey_year order by count(*) desc, skill) as r
            from listed join (select survey_year, count(distinct response_id) as answered
                              from listed where role = 'Data engineer' group by 1)
                 using (survey_year)
            where role = 'Data engineer' group by 1, 2) where r <= 4)"""


def rounded(df, columns, digits=6):
    return df.withColumns({c: round_half_away(F.col(c), digits) for c in columns})


def trend(spark, d):
    return R.adoption_trend(M.stored(A.adoption(spark, d)))


@query("adoption_trend", "select * from trend")
def _(spark, d):
    return trend(spark, d)


@query(
    "adoption_trend_filtered",
    """with s as (
           select year, technology_name, technology_category, survey_adoption_pct from adoption
           where data_source = 'stackoverflow' and technology_category = 'database'
             and year between 1997 and 2000)
       select * from s where technology_name in (
           select technology_name from s group by 1
           order by avg(survey_adoption_pct) desc, technology_name limit 3)""",
)
def _(spark, d):
    return R.adoption_trend(
        M.stored(A.adoption(spark, d)), "database", "stackoverflow", n=3, years=(1997, 2000)
    )


@query(
    "adoption_headline",
    """with y as (select max(year) as y from trend),
       top as (select year, technology_name, avg(survey_adoption_pct) as pct from trend, y
               where year = y.y group by 1, 2 order by 3 desc, 2 limit 1)
       select top.year as latest_year, technology_name as top_technology, pct as top_pct,
              round(pct - (select avg(survey_adoption_pct) from trend t
                           where t.technology_name = top.technology_name
                             and t.year = top.year - 1), 1) as yoy_delta,
              (select count(distinct technology_name) from trend) as technologies_shown
       from top""",
)
def _(spark, d):
    return R.adoption_headline(trend(spark, d))


@query(
    "adoption_context",
    """select technology_name, technology_name || ': ' || string_agg(
              year || ': ' || printf('%.1f', round(survey_adoption_pct, 1)) || '%', ', '
              order by year) as context_line
       from trend where technology_name in (
           select technology_name from trend group by 1
           order by avg(survey_adoption_pct) desc, technology_name limit 10) group by 1""",
)
def _(spark, d):
    return R.adoption_context(trend(spark, d))


SVD_TOP = """
    select year, technology_name, technology_category, avg_survey_adoption_pct,
           coalesce(github_activity_pct, 0) as github_activity_pct, said_vs_did_gap,
           said_vs_did_classification
    from svd where avg_survey_adoption_pct is not null and year = {}
    order by said_vs_did_gap desc nulls last, technology_name limit 25"""


@query("said_vs_did_report", SVD_TOP.format("(select max(year) from svd)"))
def _(spark, d):
    return R.said_vs_did_report(M.stored(M.svd(spark, d)))


@query(
    "said_vs_did_summary",
    f"""select count(*) filter (where said_vs_did_classification = 'over_reported')
                  as over_reported,
              count(*) filter (where said_vs_did_classification = 'under_reported')
                  as under_reported,
              count(*) filter (where said_vs_did_classification = 'consistent') as consistent,
              first(technology_name order by said_vs_did_gap desc, technology_name)
                  as widest_technology,
              max(said_vs_did_gap) as widest_gap from ({SVD_TOP.format(1998)})""",
)
def _(spark, d):
    return R.said_vs_did_summary(R.said_vs_did_report(M.stored(M.svd(spark, d)), 1998))


@query(
    "country_totals",
    """select country, cast(sum(respondent_count) as bigint) as respondents from salary
       where survey_year = 1998 and respondent_count >= 1 and country is not null
       group by 1 order by 2 desc, 1 limit 10""",
)
def _(spark, d):
    return R.country_totals(M.salary(spark, d), 1998, 10, min_respondents=1)


ROLLUP = """
    select technology_name, technology_category,
           quantile_cont(median_salary, 0.5) as median_salary,
           quantile_cont(p25_salary, 0.5) as p25_salary,
           quantile_cont(p75_salary, 0.5) as p75_salary,
           avg(salary_premium_pct) as salary_premium_pct,
           cast(sum(respondent_count) as bigint) as respondent_count,
           avg(global_median_salary) as global_median_salary
    from salary where survey_year = 1999 {} group by 1, 2"""
ROLLUP_MEANS = """round(salary_premium_pct, 6) as salary_premium_pct,
                  round(global_median_salary, 6) as global_median_salary"""


@query(
    "salary_rollup", f"select * replace ({ROLLUP_MEANS}) from ({ROLLUP.format('')})"
)
def _(spark, d):
    rows = M.salary(spark, d).where(F.col("survey_year") == 1999)
    return rounded(R.salary_rollup(rows), ["salary_premium_pct", "global_median_salary"])


@query(
    "salary_report",
    f"""with b as ({ROLLUP.format('and years_coding_professional = 2 and respondent_count >= 1')}
               order by median_salary desc, technology_name limit 8)
        select * replace ({ROLLUP_MEANS}), greatest(p75_salary - median_salary, 0) as arm_above,
               greatest(median_salary - p25_salary, 0) as arm_below,
               greatest(0.4, least(1.0, respondent_count / max(respondent_count) over ()))
                   ::double as confidence
        from b""",
)
def _(spark, d):
    report = R.salary_report(
        M.salary(spark, d), 1999, experience=2, n=8, min_respondents=1
    )
    return rounded(report, ["salary_premium_pct", "global_median_salary"])


@query(
    "salary_summary",
    f"""with b as ({ROLLUP.format('')} order by median_salary desc, technology_name limit 12)
        select first(technology_name order by median_salary desc, technology_name)
                   as top_technology_name,
               max(median_salary) as top_median_salary,
               last(technology_name order by median_salary desc, technology_name)
                   as bottom_technology_name,
               min(median_salary) as bottom_median_salary,
               round(avg(global_median_salary), 6) as global_median_salary,
               count(*) as technologies_shown from b""",
)
def _(spark, d):
    report = R.salary_report(M.salary(spark, d), 1999, n=12, min_respondents=1)
    return rounded(R.salary_summary(report), ["global_median_salary"])


@query(
    "role_skills",
    SKILLS
    + """ select * from shares where role = 'Data engineer'
          order by skill_count desc, skill limit 5""",
)
def _(spark, d):
    return R.role_skills(A.raw_survey_a(spark, d, profile=True), "Data engineer", SKILL, 5)


@query(
    "role_skills_compare",
    SKILLS
    + """ select role, skill, skill_count, pct from (
              select *, row_number() over (partition by role order by skill_count desc, skill) as r
              from shares) where r <= 3""",
)
def _(spark, d):
    return R.role_skills_compare(A.raw_survey_a(spark, d, profile=True), SKILL, 3)


@query(
    "role_skills_trend",
    SKILLS
    + """ select * from yearly
          where skill in (select skill from yearly where survey_year = 1999)""",
)
def _(spark, d):
    surveys = A.raw_survey_a(spark, d, profile=True)
    return R.role_skills_trend(surveys, "Data engineer", SKILL, 1999, n=4)


@query(
    "skills_text",
    SKILLS
    + """ select role, string_agg(skill || ' (' || pct || '%)', ', '
                     order by skill_count desc, skill) as skill_summary
          from shares group by 1""",
)
def _(spark, d):
    labelled = A.raw_survey_a(spark, d, profile=True)
    return R.skills_text(R.role_skills_compare(labelled, SKILL, None))


@query(
    "top_gaps",
    """select year, technology_name, technology_category, avg_survey_adoption_pct,
              github_activity_pct, said_vs_did_gap, said_vs_did_classification
       from svd where year >= 1998
       order by abs(said_vs_did_gap) desc nulls first, year, technology_name limit 30""",
)
def _(spark, d):
    return R.top_gaps(M.stored(M.svd(spark, d)), 1998)


@query(
    "latest_sentiment",
    """select year, technology_name, technology_category, adoption_pct, desire_pct, desire_gap,
              adoption_yoy_change, lifecycle_stage
       from sentiment where year = (select max(year) from sentiment)
       order by desire_gap desc, technology_name limit 25""",
)
def _(spark, d):
    return R.latest_sentiment(M.stored(M.sentiment(spark, d)))


@query(
    "salary_premiums",
    """select technology_name, technology_category,
              round(avg(median_salary), 4) as avg_median_salary,
              round(avg(salary_premium_pct), 4) as avg_premium_pct,
              cast(sum(respondent_count) as bigint) as total_respondents
       from salary where survey_year = (select max(survey_year) from salary)
         and country = 'NATION_3' group by 1, 2 having sum(respondent_count) >= 2
       order by avg(salary_premium_pct) desc, 1 limit 20""",
)
def _(spark, d):
    report = R.salary_premiums(M.stored(M.salary(spark, d)), "NATION_3", min_respondents=2)
    return rounded(report, ["avg_median_salary", "avg_premium_pct"], 4)


@query(
    "emerging_declining",
    """select technology_name, lifecycle_stage, adoption_pct, desire_pct, desire_gap
       from sentiment where year = (select max(year) from sentiment)
         and lifecycle_stage in ('emerging', 'declining')""",
)
def _(spark, d):
    return R.emerging_declining(M.stored(M.sentiment(spark, d)))
