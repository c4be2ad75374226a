import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from devpulse.operators import quantiles
from devpulse.operators.aggregates import grouped_distinct_counts
from devpulse.reporting import profiling, reports


def adoption(spark):
    lines = [
        (2023, "Go", "language", "stackoverflow", 10.0), (2024, "Go", "language", "stackoverflow", 14.0),
        (2024, "Go", "language", "jetbrains", 16.0), (2024, "Rust", "language", "stackoverflow", 15.0),
        (2022, "Rust", "language", "stackoverflow", 11.0), (2024, "MySQL", "database", "jetbrains", 1.0),
        (2024, "Go", "language", "github", None),
    ]
    return spark.createDataFrame(
        lines, "year int, technology_name string, technology_category string, data_source string, survey_adoption_pct double"
    )


def test_adoption_trend(spark, rows):
    trend = reports.adoption_trend(adoption(spark), n=2)
    assert rows(trend, "year", "technology_name", "survey_adoption_pct") == [
        (2022, "Rust", 11.0), (2023, "Go", 10.0), (2024, "Go", 15.0), (2024, "Rust", 15.0),
    ]
    only = reports.adoption_trend(adoption(spark), "language", "jetbrains")
    assert rows(only, "technology_name", "survey_adoption_pct") == [("Go", 16.0)]
    assert reports.adoption_trend(adoption(spark), years=(2022, 2023)).count() == 2


def test_adoption_headline_and_context(spark):
    trend = reports.adoption_trend(adoption(spark), n=2)
    head = reports.adoption_headline(trend).first()
    assert tuple(head) == (2024, "Go", 15.0, 5.0, 2)  # the tie goes to the first name
    lines = {r.technology_name: r.context_line for r in reports.adoption_context(trend).collect()}
    assert lines == {"Go": "Go: 2023: 10.0%, 2024: 15.0%", "Rust": "Rust: 2022: 11.0%, 2024: 15.0%"}
    rust = reports.adoption_headline(trend.where("technology_name = 'Rust'")).first()
    assert rust.yoy_delta is None  # no row for the year before


def svd(spark):
    lines = [
        (2024, "a", 10.0, 4.0, 6.0, "over_reported"), (2024, "b", 5.0, None, 5.0, "over_reported"),
        (2024, "c", 1.0, 9.0, -8.0, "under_reported"), (2024, "d", None, 9.0, None, "consistent"),
        (2021, "a", 50.0, 1.0, 49.0, "over_reported"),
    ]
    return spark.createDataFrame(
        lines, "year int, technology_name string, avg_survey_adoption_pct double, github_activity_pct double, "
        "said_vs_did_gap double, said_vs_did_classification string",
    ).withColumn("technology_category", F.lit("x"))


def test_said_vs_did_report(spark):
    report = reports.said_vs_did_report(svd(spark))
    assert [(r.technology_name, r.github_activity_pct) for r in report.collect()] == [("a", 4.0), ("b", 0.0), ("c", 9.0)]
    assert tuple(reports.said_vs_did_summary(report).first()) == (2, 1, 0, "a", 6.0)
    assert [r.technology_name for r in reports.top_gaps(svd(spark)).collect()] == ["d", "c", "a", "b"]


def salary(spark):
    lines = [
        (2024, "Go", "X", 1, 10, 50.0, 60.0, 40.0, 5.0), (2024, "Go", "Y", 2, 30, 70.0, 65.0, 80.0, 9.0),
        (2024, "Rust", "X", 1, 100, 90.0, 80.0, 99.0, 20.0), (2024, "Zig", "X", 1, 9, 999.0, 1.0, 1.0, 1.0),
        (2023, "Go", "X", 1, 99, 10.0, 10.0, 10.0, 1.0),
    ]
    return spark.createDataFrame(
        lines, "survey_year int, technology_name string, country string, years_coding_professional int, "
        "respondent_count long, median_salary double, p25_salary double, p75_salary double, salary_premium_pct double",
    ).withColumn("technology_category", F.lit("language")).withColumn("global_median_salary", F.lit(60.0))


def test_salary_report(spark, rows):
    report = reports.salary_report(salary(spark), 2024)
    got = rows(report, "technology_name", "median_salary", "respondent_count", "arm_above", "arm_below", "confidence")
    assert got == [("Go", 60.0, 40, 0.0, 0.0, 0.4), ("Rust", 90.0, 100, 9.0, 10.0, 1.0)]
    assert tuple(reports.salary_summary(report).first()) == ("Rust", 90.0, "Go", 60.0, 60.0, 2)
    assert rows(reports.salary_report(salary(spark), 2024, country="Y"), "technology_name") == [("Go",)]
    assert reports.salary_report(salary(spark), 2024, experience=1).count() == 2
    assert rows(reports.country_totals(salary(spark), 2024)) == [("X", 110), ("Y", 30)]
    assert rows(reports.salary_premiums(salary(spark), "X", 50), "technology_name", "avg_premium_pct") == [("Rust", 20.0)]


def test_sentiment_reports(spark):
    df = spark.createDataFrame(
        [(2023, "old", 9.0, "emerging"), (2024, "a", 1.0, "emerging"), (2024, "b", 3.0, "declining"), (2024, "c", 9.0, "stable")],
        "year int, technology_name string, desire_gap double, lifecycle_stage string",
    ).withColumns({c: F.lit(1.0) for c in ("adoption_pct", "desire_pct", "adoption_yoy_change")}).withColumn(
        "technology_category", F.lit("x")
    )
    assert [r.technology_name for r in reports.latest_sentiment(df, 2).collect()] == ["c", "b"]
    assert [r.technology_name for r in reports.emerging_declining(df).collect()] == ["b", "a"]


def skills(spark):
    people = [
        (2023, "Data engineer", "SQL;Python"), (2023, "Data engineer", "SQL"), (2024, "Data engineer", "Python;Go"),
        (2024, "Data engineer", "Python"), (2024, "Data engineer", None), (2024, "Data scientist", "R"),
    ]
    return spark.createDataFrame(people, "survey_year int, dev_type string, language_have_worked_with string")


def test_role_skill_reports(spark, rows):
    column = "language_have_worked_with"
    top = reports.role_skills(skills(spark), "Data engineer", column, 2)
    assert [(r.skill, r.skill_count, r.pct) for r in top.collect()] == [("Python", 3, 75.0), ("SQL", 2, 50.0)]
    both = reports.role_skills_compare(skills(spark), column, 1)
    assert rows(both, "role", "skill") == [("Data engineer", "Python"), ("Data scientist / ML", "R")]
    trend = reports.role_skills_trend(skills(spark), "Data engineer", column, 2024)
    assert rows(trend, "survey_year", "skill", "pct") == [(2023, "Python", 50.0), (2024, "Go", 50.0), (2024, "Python", 100.0)]
    text = {r.role: r.skill_summary for r in reports.skills_text(reports.role_skills_compare(skills(spark), column, 2)).collect()}
    assert text["Data engineer"] == "Python (75.0%), SQL (50.0%)"


def test_null_and_duplicate_reports(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i int, `a.b` string")
    assert [tuple(r) for r in profiling.null_report(df).collect()] == [("a.b", 3, 2, 66.67), ("i", 3, 0, 0.0)]
    assert profiling.duplicate_report(df, ["i", "nope"]).first() == (2, 3, 66.67)
    assert [tuple(r) for r in profiling.value_distribution(df.toDF("i", "v"), "v", 5).collect()] == [(None, 2), ("x", 1)]


def test_histogram(spark):
    df = spark.createDataFrame([("0",), ("10",), ("9.9",), ("5",), ("text",), (None,)], "v string")
    bins = profiling.histogram(df, "v", 4).orderBy("bin").collect()
    assert [r.row_count for r in bins] == [1, 0, 1, 2]
    assert (bins[0].lower_edge, bins[-1].upper_edge) == (0.0, 10.0)
    same = profiling.histogram(spark.createDataFrame([("3",)], "v string"), "v", 2).orderBy("bin").collect()
    assert [(r.lower_edge, r.row_count) for r in same] == [(2.5, 0), (3.0, 1)]


@pytest.mark.parametrize("kind", ["spread", "one hot value", "few values", "two rows"])
def test_exact_quantiles_match_brute_force(spark, kind):
    random.seed(7)
    values = {
        "spread": [random.lognormvariate(0, 3) for _ in range(5000)],
        "one hot value": [1.5] * 4000 + [random.random() for _ in range(999)],
        "few values": [float(random.randint(1, 5)) for _ in range(1000)],
        "two rows": [1.0, 2.0],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(8)
    points = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.97, "e": 1.0}
    got = profiling.exact_quantiles(df, ["v"], points).first()
    ordered = sorted(values)
    for name, p in points.items():
        place = p * (len(ordered) - 1)
        low, high = ordered[int(place)], ordered[min(int(place) + 1, len(ordered) - 1)]
        assert got[name] == pytest.approx(low + (high - low) * (place - int(place)), rel=1e-12)


@pytest.mark.parametrize("accuracy", [10_000, 25])
def test_group_quantiles_with_a_hot_group(spark, monkeypatch, accuracy):
    """One group holds nearly all rows; NULL keys are a group, NULL values don't count.  A coarse
    sketch makes brackets, gaps and slices of every group."""
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    random.seed(8)
    data = [("hot", random.lognormvariate(0, 4)) for _ in range(20_000)]
    data += [(k, float(random.randint(0, 9))) for k in ("a", None) for _ in range(150)]
    data += [("hot", None), ("empty", None), ("one", 3.5)]
    df = spark.createDataFrame(data, "k string, v double").repartition(6)
    points = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.501, "e": 0.999, "f": 1.0}
    got = {r.k: r for r in quantiles.group_quantiles(df, ["k"], "v", points).collect()}
    assert got.keys() == {"hot", "a", None, "one"}
    for k, row in got.items():
        ordered = sorted(v for x, v in data if x == k and v is not None)
        for name, p in points.items():
            place = p * (len(ordered) - 1)
            low, high = ordered[int(place)], ordered[min(int(place) + 1, len(ordered) - 1)]
            assert row[name] == pytest.approx(low + (high - low) * (place - int(place)), rel=1e-12), (k, name)


def test_distinct_counts_of_every_kind(spark):
    """Negative and huge numbers, days, texts, doubles of both zeros, NULLs and NULL keys."""
    random.seed(9)
    data = [
        (random.choice(["x", "y", None]), random.choice([None, -(2**63), -65, -64, -1, 0, 63, 64, 2**63 - 1]),
         random.choice([None, dt.date(1969, 12, 30), dt.date(1970, 1, 1), dt.date(2024, 1, 1)]),
         random.choice([None, "", "a", "A"]), random.choice([None, 0.0, -0.0, 1.5]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, "k string, n long, d date, t string, f double").repartition(5)
    counted = {"ns": "n", "ds": "d", "ts": "t", "fs": "f"}
    got = grouped_distinct_counts(df, ["k"], {"rows": ("count", "*"), "top": ("max", "n"), "filled": ("count", "t")}, counted)
    want = {}
    for k in ("x", "y", None):
        own = [r for r in data if r[0] == k]
        distinct = [len({r[i] for r in own} - {None}) for i in (1, 2, 3, 4)]
        want[k] = (len(own), max(r[1] for r in own if r[1] is not None), sum(r[3] is not None for r in own), *distinct)
    assert {r.k: (r.rows, r.top, r.filled, r.ns, r.ds, r.ts, r.fs) for r in got.collect()} == want
    nothing = grouped_distinct_counts(df.limit(0), [], {"rows": ("count", "*")}, {"ns": "n"}).first()
    assert (nothing.ns, nothing.rows or 0) == (0, 0)


def test_describe_numeric(spark):
    df = spark.createDataFrame([("1", 2), ("2", 4), ("x", 6), (None, 8)], "a string, b int")
    got = {r.column_name: r for r in profiling.describe_numeric(df, ["a", "b"]).collect()}
    assert (got["a"]["count"], got["a"]["mean"], got["a"]["p50"]) == (2, 1.5, 1.5)
    b = got["b"]
    assert (b["count"], b["mean"], b["min"], b["p25"], b["p50"], b["p75"], b["max"]) == (4, 5.0, 2.0, 3.5, 5.0, 6.5, 8.0)
    assert b["std"] == round(statistics.stdev([2, 4, 6, 8]), 2)


def test_yearly_profiles(spark, rows):
    df = spark.createDataFrame([(2023, "a", None), (2023, None, None), (2024, "b", "c")], "survey_year int, l string, m string")
    assert rows(profiling.rows_by_year(df)) == [(2023, 2), (2024, 1)]
    assert rows(profiling.fill_rates(df, ["l", "m"])) == [
        (2023, "l", 50.0), (2023, "m", 0.0), (2024, "l", 100.0), (2024, "m", 100.0),
    ]
    months = spark.createDataFrame([("2024-01", "Go", 3), ("2024-02", "Go", 4), ("2024-01", "C", 9)], "activity_month string, lang string, event_count int")
    assert profiling.range_and_cardinality(months, "activity_month", ["lang"]).first() == (3, "2024-01", "2024-02", 2)
    assert [tuple(r) for r in profiling.top_by_sum(months, "lang", "event_count", 1).collect()] == [("C", 9)]
    assert [tuple(r) for r in profiling.monthly_trend(months).collect()] == [("2024-01", 12), ("2024-02", 4)]
