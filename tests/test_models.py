"""Operators and models on hand-built rows with hand-computed answers."""

import math

import pytest
from pyspark.sql import functions as F

from devpulse.operators import aggregates, joins, ordering, reshape, roles, staging, windows
from devpulse.plans import activity, adoption, anomalies, compare, dimension, marts, salary
from devpulse.plans import sentiment as lifecycle
from devpulse.plans.spine import mapping_seed, technologies, technology_spine


@pytest.fixture(scope="module")
def spine(spark):
    return technology_spine(mapping_seed(spark))


def survey_a(spark, *people):
    """People as (id, year, languages used, languages desired)."""
    raw = spark.createDataFrame(
        list(people),
        "response_id string, survey_year int, language_have_worked_with string, "
        "language_want_to_work_with string",
    )
    return staging.stage_survey_a(raw)


def test_explode_multiselect_drops_blanks(spark, rows):
    df = spark.createDataFrame([(1, "a; b;;c"), (2, ""), (3, None), (4, "a;a"), (5, " ; ")], "i int, l string")
    assert rows(reshape.explode_multiselect(df, "l"), "i", "technology_name") == [
        (1, "a"), (1, "b"), (1, "c"), (4, "a"), (4, "a"),
    ]
    blanks = roles.explode_skills(df, "l").where("skill = ''")
    assert rows(blanks, "i") == [(1,), (2,), (5,), (5,)]


def test_separator_is_no_pattern(spark, rows):
    df = spark.createDataFrame([("a.b|c",)], "l string")
    assert rows(reshape.explode_multiselect(df, "l", "|"), "technology_name") == [("a.b",), ("c",)]
    assert rows(reshape.explode_multiselect(df, "l", "."), "technology_name") == [("a",), ("b|c",)]


def test_unpivot_a_merges_used_and_desired(spark, rows):
    staged = survey_a(spark, ("1", 2024, "Go;Go; Rust", "Go;Zig"), (None, 2024, "Go", None))
    got = rows(reshape.unpivot_survey_a(staged), "technology_name", "is_currently_used", "is_desired")
    assert got == [("Go", True, True), ("Rust", True, False), ("Zig", False, True)]


def test_unpivot_a_reads_the_surveys_once(spark, tmp_path):
    survey_a(spark, ("1", 2024, "Go", "Go")).write.parquet(str(tmp_path / "s"))
    plan = reshape.unpivot_survey_a(spark.read.parquet(str(tmp_path / "s")))
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_unpivot_b_marks_the_primary_language(spark, rows):
    raw = spark.createDataFrame(
        [("1", 2024, "Go", "Go;Rust", "Go;Zig", "Spring")],
        "response_id string, survey_year int, primary_language string, languages_used string, "
        "languages_plan_to_adopt string, frameworks_used string",
    )
    got = rows(
        reshape.unpivot_survey_b(staging.stage_survey_b(raw)),
        "technology_name", "technology_category", "is_currently_used", "is_primary",
    )
    assert got == [
        ("Go", "language", True, True),
        ("Rust", "language", True, False),
        ("Spring", "framework", True, False),
        ("Zig", "language", False, False),
    ]


def test_unpivot_b_without_primary_language(spark, rows):
    raw = spark.createDataFrame(
        [("1", 2024, None, "Go")],
        "response_id string, survey_year int, primary_language string, languages_used string",
    )
    assert rows(reshape.unpivot_survey_b(staging.stage_survey_b(raw)), "is_primary") == [(False,)]


def test_stage_survey_a_numbers(spark):
    raw = spark.createDataFrame(
        [("1", 2024, "Less than 1 year", "7", "60000.5")],
        "response_id string, survey_year int, years_code string, years_code_pro string, comp_total string",
    )
    row = staging.stage_survey_a(raw).first()
    assert (row.years_coding_total, row.years_coding_professional, row.compensation_total) == (None, 7, 60001)
    assert len(row) == 31


def test_stage_activity_filters_and_fills(spark, rows):
    raw = spark.createDataFrame(
        [("2024-03-01", lang, "PushEvent", n) for lang, n in (("Go", 5), ("Unknown", 5), (None, 5), ("C", 0))],
        "activity_month string, repo_language string, event_type string, event_count long",
    )
    got = rows(
        staging.stage_activity(raw), "repo_language", "total_commits", "avg_repo_stars",
        F.col("activity_year").cast("string"),
    )
    assert got == [("Go", 0, 0.0, "2024-01-01")]


def yearly_a(spark, spine, *people):
    staged = survey_a(spark, *people)
    return adoption.adoption_a(reshape.unpivot_survey_a(staged), staged, spine)


def test_adoption_counts_people_once_and_divides_by_everyone(spark, spine, rows):
    people = [
        ("1", 2024, "JavaScript;Javascript", "Rust"),  # two names of one technology
        ("2", 2024, "JavaScript;Fortran", None),  # one unmapped
        ("3", 2024, None, None),  # still a respondent
        ("1", 2023, "Rust", None),  # same id, other year
    ]
    got = rows(
        yearly_a(spark, spine, *people), "survey_year", "technology_name", "users_count",
        "desired_count", "total_respondents", "adoption_pct", "desire_pct",
    )
    assert got == [
        (2023, "Rust", 1, 0, 1, 100.0, 0.0),
        (2024, "JavaScript", 2, 0, 3, 66.67, 0.0),
        (2024, "Rust", 0, 1, 3, 0.0, 33.33),
    ]


def test_adoption_from_exploded_rows_equals_consolidated(spark, spine, rows):
    staged = survey_a(spark, ("1", 2024, "Go;Golang", "Go"), ("2", 2024, "Go", None))
    totals = staged.select("survey_response_id", "response_id", "survey_year")
    direct = adoption.adoption_a(reshape.technology_rows_a(staged), totals, spine)
    natural = ("response_id", "survey_year")
    by_natural = adoption.adoption_a(reshape.technology_rows_a(staged, natural), totals, spine, natural)
    consolidated = adoption.adoption_a(reshape.unpivot_survey_a(staged), totals, spine)
    assert rows(direct) == rows(consolidated) == rows(by_natural)
    assert rows(direct, "users_count") == [(2,)]


def monthly(spark, *lines):
    raw = spark.createDataFrame(
        [(f"{y}-0{m}-01", lang, "PushEvent", n, a, 1, 1.0) for y, m, lang, n, a in lines],
        "activity_month string, repo_language string, event_type string, event_count long, "
        "unique_actors long, unique_repos long, avg_repo_stars double",
    )
    return staging.stage_activity(raw)


def test_activity_shares_are_over_mapped_languages(spark, spine, rows):
    yearly = activity.activity_yearly(
        monthly(spark, (2024, 1, "Go", 30, 1), (2024, 2, "Golang", 30, 2), (2024, 1, "Rust", 40, 1),
                (2024, 1, "Brainfuck", 900, 9)),
        spine,
    )
    got = rows(yearly, "technology_name", "total_events", "total_unique_actors", "event_share", "actor_share")
    assert got == [("Go", 60, 3, 0.6, 0.75), ("Rust", 40, 1, 0.4, 0.25)]


def facts(spark, spine, *lines):
    """Adoption facts from (year, name, source, survey pct, desire, event share)."""
    df = spark.createDataFrame(
        list(lines),
        "year int, technology_name string, data_source string, survey_adoption_pct double, "
        "survey_desire_pct double, github_event_share double",
    ).withColumn("technology_category", F.lit("language"))
    return adoption.align_typed_nulls(df)


@pytest.mark.parametrize(
    "said, share, gap, label",
    [
        (15.0, 0.10, 5.0, "consistent"),  # exactly 1.5 times
        (15.01, 0.10, 5.01, "over_reported"),
        (10.0, 0.15, -5.0, "consistent"),
        (10.0, 0.16, -6.0, "under_reported"),
        (5.0, None, 5.0, "over_reported"),  # survey only
        (0.0, None, 0.0, "consistent"),
        (None, 0.2, None, "consistent"),  # activity only
    ],
)
def test_said_vs_did(spark, spine, said, share, gap, label):
    lines = []
    if said is not None:
        lines.append((2024, "Go", "stackoverflow", said, 1.0, None))
    if share is not None:
        lines.append((2024, "Go", "github", None, None, share))
    row = compare.said_vs_did(facts(spark, spine, *lines), technologies(spine)).collect()
    assert len(row) == 1
    assert row[0].said_vs_did_gap == gap and row[0].said_vs_did_classification == label
    assert row[0].technology_subcategory == "systems"
    assert (row[0].technology_category is None) == (said is None)


def test_said_vs_did_averages_the_surveys(spark, spine):
    df = facts(
        spark, spine,
        (2024, "Go", "stackoverflow", 10.0, 7.0, None), (2024, "Go", "jetbrains", 20.0, None, None),
        (2023, "Go", "github", None, None, 0.5),
    )
    got = {r.year: r for r in compare.said_vs_did(df, technologies(spine)).collect()}
    assert got[2024].avg_survey_adoption_pct == 15.0 and got[2024].max_survey_desire_pct == 7.0
    assert got[2023].github_activity_pct == 50.0


def test_lifecycle_stages(spark, spine):
    def year(y, use, want, name="Go"):
        return (y, name, "language", use, want, 1, 1, 100)

    df = spark.createDataFrame(
        [
            year(2020, 5.0, 9.0), year(2021, 5.0, 9.5), year(2023, 5.0, 9.5), year(2024, 9.0, 8.0),
            year(2025, 8.5, 8.0), year(2020, 5.0, 5.0, "Rust"),
        ],
        "survey_year int, technology_name string, technology_category string, adoption_pct double, "
        "desire_pct double, users_count long, desired_count long, total_respondents long",
    )
    got = {
        (r.technology_name, r.year): (r.lifecycle_stage, r.desire_gap)
        for r in lifecycle.technology_sentiment(df, technologies(spine)).collect()
    }
    assert got == {
        ("Go", 2020): ("growing_interest", 4.0),  # first year has no change
        ("Go", 2021): ("emerging", 4.5),
        ("Go", 2023): ("growing_interest", 4.5),  # compared with 2021, the row before
        ("Go", 2024): ("established_but_waning", -1.0),
        ("Go", 2025): ("declining", -0.5),
        ("Rust", 2020): ("stable", 0.0),
    }


def test_anomalies_need_history_spread_and_distance(spark, spine, rows):
    def series(name, *rates):
        return [(2020 + i, name, "stackoverflow", r, None, None) for i, r in enumerate(rates)]

    spread = 2 / math.sqrt(2)  # deviation of 10 and 12
    df = facts(
        spark, spine,
        *series("one row of history", 1.0, 50.0),
        *series("flat", 5.0, 5.0, 50.0),
        *series("near", 10.0, 12.0, 11.0 + 1.99 * spread),
        *series("medium", 10.0, 12.0, 11.0 + 2.5 * spread),
        *series("high", 10.0, 12.0, 11.0 - 3.5 * spread),
    )
    got = rows(
        anomalies.adoption_anomalies(df), "technology_name", "z_score", "anomaly_direction", "severity"
    )
    assert got == [("high", -3.5, "drop", "high"), ("medium", 2.5, "spike", "medium")]


def paid(spark, *people):
    """People as (id, pay, frequency, languages)."""
    raw = spark.createDataFrame(
        list(people),
        "response_id string, comp_total string, comp_freq string, language_have_worked_with string",
    )
    fixed = raw.withColumns(
        {"survey_year": F.lit(2024), "country": F.lit("X"), "dev_type": F.lit(None).cast("string")}
    )
    return staging.stage_survey_a(fixed)


def test_pay_limits(spark, rows):
    df = paid(
        spark, ("1", "9999", "Yearly", ""), ("2", "10000", "Yearly", ""), ("3", "1000000", "Yearly", ""),
        ("4", "1000001", "Yearly", ""), ("5", "50000", "Monthly", ""), ("6", "lots", "Yearly", ""),
        ("7", None, "Yearly", ""), ("8", "50000", None, ""), ("9", "9" * 40, "Yearly", ""),
    )
    assert rows(salary.filter_valid_salary(df), "response_id") == [("2",), ("3",)]


PEOPLE = [
    ("1", "20000", "Yearly", "JavaScript;Javascript"),
    ("2", "40000", "Yearly", "JavaScript"),
    ("3", "90000", "Yearly", "Go;Fortran"),
]


@pytest.mark.parametrize("general", [True, False])
def test_salary_counts_a_person_once_per_name(spark, spine, rows, general):
    surveys = paid(spark, *PEOPLE)
    tech = reshape.unpivot_survey_a(surveys) if general else None
    df = salary.salary_by_stack(surveys, tech, spine, technologies(spine))
    columns = [
        "technology_name", "respondent_count", "avg_salary", "median_salary", "p25_salary",
        "p75_salary", "min_salary", "max_salary", "global_median_salary", "salary_premium_pct",
    ]
    assert rows(df, *columns) == [
        ("Go", 1, 90000.0, 90000.0, 90000.0, 90000.0, 90000, 90000, 55000.0, 63.64),
        ("JavaScript", 3, 26667.0, 20000.0, 20000.0, 30000.0, 20000, 40000, 55000.0, -63.64),
    ]


@pytest.mark.parametrize("general", [True, False])
def test_salary_can_count_a_person_once(spark, spine, rows, general):
    surveys = paid(spark, *PEOPLE)
    tech = reshape.unpivot_survey_a(surveys) if general else None
    df = salary.salary_by_stack(surveys, tech, spine, technologies(spine), dedupe=True)
    assert rows(df, "technology_name", "respondent_count", "median_salary") == [
        ("Go", 1, 90000.0), ("JavaScript", 2, 30000.0),
    ]


def test_approximate_pay_is_close(spark, spine):
    surveys = paid(spark, *[(str(i), str(20000 + i * 10), "Yearly", "Go") for i in range(500)])
    mapped = joins.join_spine(salary.paid_technologies_in_place(surveys), spine, "technology_name")
    exact = aggregates.salary_stats(mapped, ["technology_name"]).first()
    near = aggregates.salary_stats(mapped, ["technology_name"], accuracy=1000).first()
    assert exact.median_salary == 22495.0
    assert abs(near.median_salary - exact.median_salary) < 20
    assert near.respondent_count == exact.respondent_count == 500


def test_name_in_two_categories_counts_twice_but_does_not_fan_out(spark, spine, rows):
    raw = spark.createDataFrame(
        [("1", 2024, "50000", "Yearly", "Firebase", "Firebase")],
        "response_id string, survey_year int, comp_total string, comp_freq string, "
        "database_have_worked_with string, platform_have_worked_with string",
    )
    surveys = staging.stage_survey_a(raw)
    tech = reshape.unpivot_survey_a(surveys)
    for route in (tech, None):
        df = salary.salary_by_stack(surveys, route, spine, technologies(spine))
        assert rows(df, "technology_name", "technology_category", "respondent_count") == [
            ("Firebase", "database", 2)
        ]


def test_dimension_flags(spark, spine, rows):
    def known(*names):
        return spark.createDataFrame([(n,) for n in names], "technology_name string")

    dim = dimension.dim_technologies(spine, known("Go", "Go"), known("Go", "Rust"), known("Go", "Nope"))
    assert dim.count() == 74
    got = dim.where("technology_name in ('Go', 'Rust', 'Zig')")
    assert rows(got, "technology_name", "in_stackoverflow", "in_jetbrains", "in_github", "source_coverage_count") == [
        ("Go", True, True, True, 3), ("Rust", False, True, False, 1), ("Zig", False, False, False, 0),
    ]


def test_trailing_stats_frames(spark):
    df = spark.createDataFrame(
        [("a", "s", y, v) for y, v in ((1, 1.0), (2, 3.0), (3, 5.0), (4, 0.0))],
        "technology_name string, data_source string, year int, adoption_pct double",
    )
    got = {r.year: (r.trailing_avg, r.prior_years_count) for r in windows.trailing_stats(df).collect()}
    assert got == {1: (None, 0), 2: (1.0, 1), 3: (2.0, 2), 4: (4.0, 3)}


def test_joins_and_orders(spark, rows):
    df = spark.createDataFrame([(1, "a", 3.0), (1, "b", -9.0), (2, "a", None), (2, "c", 9.0)], "y int, n string, v double")
    assert rows(joins.latest_year_rows(df, "y"), "n") == [("a",), ("c",)]
    pairs = joins.cross_expected(df, "y", ["a", "b"], "n")
    assert rows(joins.anti_missing(pairs, df, ["y", "n"])) == [(2, "b")]
    assert [r.n for r in ordering.order_by_abs(df, "v", [F.asc("n")]).collect()] == ["b", "c", "a", "a"]
    assert ordering.order_by_abs(df, "v", [F.asc("n")], nulls_first=True).first().v is None
    ranked = ordering.order_by_rank(df.where("y = 1"), "n", ["b"], ["v"])
    assert [r.n for r in ranked.collect()] == ["b", "a"]
    assert ordering.row_at_max(df, "v", ["n", "v"], "n").first() == ("c", 9.0)
    ends = ordering.first_last(spark.createDataFrame([("a", 5), ("b", 5), ("c", 1), ("d", 1)], "n string, v int"), "v", "n")
    assert tuple(ends.first()) == ("a", 5, "d", 1)


def test_full_outer_keeps_both_sides(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, "y")], "k int, b string")
    assert rows(joins.full_outer_compare(a, b, ["k"])) == [(1, "x", None), (2, None, "y")]


def test_roles(spark, rows):
    df = spark.createDataFrame(
        [("1", "ENGINEER, DATA;Student", "Go;Go"), ("2", "Data scientist", "Go; R"), ("3", None, "Go"),
         ("4", "Data engineer;Database administrator", None)],
        "id string, dev_type string, skills string",
    )
    labelled = roles.label_roles(df)
    assert rows(labelled, "id", "role") == [
        ("1", "Data engineer"), ("2", "Data scientist / ML"), ("4", "Data engineer"), ("4", "Database administrator"),
    ]
    assert rows(roles.role_counts(labelled)) == [
        ("Data engineer", 2), ("Data scientist / ML", 1), ("Database administrator", 1),
    ]
    # the share is over rows that answered; one respondent listing a skill twice counts twice
    assert rows(roles.skill_shares(labelled, "skills", ["role"])) == [
        ("Data engineer", "Go", 2, 200.0), ("Data scientist / ML", "Go", 1, 100.0), ("Data scientist / ML", "R", 1, 100.0),
    ]


def test_marts_are_wired(spark):
    raw_a = spark.createDataFrame(
        [("1", y, "Go;Rust", "Zig", "50000", "Yearly") for y in (2021, 2022, 2023)],
        "response_id string, survey_year int, language_have_worked_with string, "
        "language_want_to_work_with string, comp_total string, comp_freq string",
    )
    raw_b = spark.createDataFrame(
        [("1", 2022, "Go", "Go;Kotlin")],
        "response_id string, survey_year int, primary_language string, languages_used string",
    )
    raw_g = spark.createDataFrame(
        [("2022-01-01", "Go", "PushEvent", 10, 2, 2)],
        "activity_month string, repo_language string, event_type string, event_count long, "
        "unique_actors long, unique_repos long",
    )
    built = marts.build_marts(raw_a, raw_b, raw_g, mapping_seed(spark))
    built.publish()
    count = {n: spark.table(n).count() for n in vars(built)}
    assert count["technology_adoption"] == 12 and count["dim_technologies"] == 74
    assert count["said_vs_did"] == 10 and count["salary_by_stack"] == 6
    assert count["technology_sentiment"] == 9 and count["adoption_anomalies"] == 0
    go = spark.table("dim_technologies").where("technology_name = 'Go'").first()
    assert go.source_coverage_count == 3


def test_shares_sum_to_one(spark, spine):
    yearly = activity.activity_yearly(
        monthly(spark, *[(y, m, n, 7 * m + y % 5, m) for y in (2023, 2024) for m in range(1, 9) for n in ("Go", "Rust", "C")]),
        spine,
    )
    for r in yearly.groupBy("activity_year").agg(F.sum("event_share").alias("s")).collect():
        assert abs(r.s - 1) < 1e-9


def test_spine_join_is_broadcast_by_its_known_size(spark, spine, tmp_path, rows):
    """Planned as a broadcast before anything runs; past the limit it is a shuffle join with
    the same rows."""
    path = str(tmp_path / "s")
    survey_a(spark, ("1", 2024, "Go;Rust", "Zig"), ("2", 2024, "Golang", None)).write.parquet(path)
    named = reshape.technology_rows_a(spark.read.parquet(path))

    def joined():
        return joins.join_spine(named, spine, "technology_name")

    def plan(df):
        return df._jdf.queryExecution().sparkPlan().toString()

    small = joined()
    assert "BroadcastHashJoin" in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joined()
        assert "SortMergeJoin" in plan(large)
        assert rows(large) == rows(small)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_counting_adds_no_shuffle_to_partitioned_respondents(spark, spine):
    """Surveys that come out of a grouping by respondent keep that partitioning up to the
    final, small, counts."""
    answers = spark.range(1000).selectExpr(
        "CAST(id % 50 AS STRING) AS response_id", "2020 + CAST(id % 3 AS INT) AS survey_year", "'Go;Rust' AS l"
    )
    grouped = answers.groupBy("response_id", "survey_year").agg(F.max("l").alias("language_have_worked_with"))
    surveys = staging.stage_survey_a(grouped)
    key = ("response_id", "survey_year")
    named = joins.join_spine(reshape.technology_rows_a(surveys, key), spine, "technology_name")
    counted = aggregates.adoption_counts(named, {"users_count": "is_currently_used"}, key)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(response_id") == 1
    assert "response_id" not in [p for p in plan.split("Exchange hashpartitioning(")[1:] if "technology_name" in p.split(")")[0]][0].split(")")[0]
