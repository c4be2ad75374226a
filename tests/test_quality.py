"""Each check must pass clean rows and catch its planted defect."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from devpulse.quality import checks, dashboard, freshness, logparse, marts
from devpulse.sources.schemas import CHECK_LOG


def reasons(df):
    return sorted(r.failure_reason for r in df.collect())


def test_declared_checks(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 50), (2, None, None), (None, "z", 500)], "i int, s string, n int")
    assert rows(checks.check_not_null(df, "s"), "i") == [(2,)]
    assert rows(checks.check_unique(df, "i")) == [(2, 2)]
    assert rows(checks.check_unique_combination(df, ["i", "s"])) == []
    assert rows(checks.check_unique_combination(df.union(df), ["i"])) == [(1, 2), (2, 4), (None, 2)]
    assert rows(checks.check_accepted_values(df, "s", ["a"])) == [("z", 1)]
    assert rows(checks.check_accepted_range(df, "n", 5, 50), "n") == [(500,)]
    assert rows(checks.check_accepted_range(df, "n", 6), "n") == [(5,)]
    assert rows(checks.check_accepted_range(df, "n", 6, 60, "s = 'z'"), "n") == [(500,)]


@pytest.mark.parametrize(
    "name, reason",
    [
        ("C++", None), ("Node.js", None), ("HTML/CSS", None), ("C#", None), (None, None),
        (" Go", "leading_or_trailing_whitespace"), ("", "empty_string"),
        ("Python 3.9", "contains_version_number"), ("Node.js 18", "contains_version_number"),
        ("Go!", "invalid_special_character"), ("Vue_3", "invalid_special_character"),
    ],
)
def test_name_standard(spark, name, reason):
    df = checks.check_name_standard(spark.createDataFrame([(name,)], "t string"), "t")
    assert reasons(df) == ([reason] if reason else [])


def test_response_range(spark):
    df = spark.createDataFrame([(99,), (100,), (300000,), (300001,), (None,)], "n int")
    assert reasons(checks.check_response_range(df, "n")) == ["above_maximum_(300000)", "below_minimum_(100)"]


def test_activity_validity(spark, rows):
    df = spark.createDataFrame(
        [("a", 2021, 0.01), ("a", 2022, 0.11), ("b", 2021, -0.1), ("c", 2021, 0.95), ("d", 2021, 0.0), ("d", 2022, 0.5)],
        "technology_name string, year int, share double",
    )
    got = rows(checks.check_activity_validity(df, "share"), "technology_name", "failure_reason")
    assert got == [("a", "yoy_spike_over_10x"), ("b", "negative_value"), ("c", "exceeds_max_share_(0.9)")]


def adoption(spark, *extra):
    clean = [("Go", y, s, p) for y in (2021, 2022) for s, p in (("stackoverflow", 10.0), ("jetbrains", 10.0), ("github", None))]
    return spark.createDataFrame(clean + list(extra), "technology_name string, year int, data_source string, survey_adoption_pct double")


def test_adoption_mart(spark, rows):
    assert reasons(marts.check_adoption_mart(adoption(spark))) == []
    repeated = adoption(spark, ("Go", 2022, "github", None))
    assert reasons(marts.check_adoption_mart(repeated)) == ["duplicate_primary_key"]
    jump = adoption(spark, ("Zig", 2021, "jetbrains", 1.0), ("Zig", 2022, "jetbrains", 51.26))
    assert reasons(marts.check_adoption_mart(jump)) == ["yoy_adoption_change_over_50ppt (50.3 ppt)"]
    fifty = adoption(spark, ("Zig", 2021, "jetbrains", 1.0), ("Zig", 2022, "jetbrains", 51.0))
    assert reasons(marts.check_adoption_mart(fifty)) == []
    missing = adoption(spark, ("Go", 2023, "jetbrains", 10.0))
    assert rows(marts.check_adoption_mart(missing)) == [
        (None, "2023", "github", "missing_data_source_for_year"),
        (None, "2023", "stackoverflow", "missing_data_source_for_year"),
    ]


SVD = (
    "technology_name string, year int, avg_survey_adoption_pct double, github_activity_pct double, "
    "said_vs_did_gap double, said_vs_did_classification string"
)


@pytest.mark.parametrize(
    "row, failing",
    [
        (("Go", 2021, 10.0, 4.0, 6.0, "over_reported"), []),
        (("Go", 2021, 10.0, 4.0, 6.4, "over_reported"), []),  # inside the tolerance
        (("Go", 2021, 10.0, None, 10.0, "over_reported"), []),
        (("Go", 2021, 10.0, 4.0, 6.6, "over_reported"), ["gap_calculation_error (actual=6.6, expected=6.0)"]),
        (("Go", 2021, 4.0, 10.0, -6.0, "over_reported"), ["classification_inconsistent_with_gap"]),
        (("Go", 2021, 10.0, 4.0, 6.0, "under_reported"), ["classification_inconsistent_with_gap"]),
        (("Go", 2021, None, None, None, "consistent"), ["no_survey_or_github_data"]),
    ],
)
def test_said_vs_did_mart(spark, row, failing):
    assert reasons(marts.check_said_vs_did_mart(spark.createDataFrame([row], SVD))) == failing


def test_said_vs_did_mart_duplicates(spark):
    df = spark.createDataFrame([("Go", 2021, 10.0, 4.0, 6.0, "over_reported")] * 2, SVD)
    assert reasons(marts.check_said_vs_did_mart(df)) == ["duplicate_primary_key"]


PAY = (
    "technology_name string, survey_year int, respondent_count long, p25_salary double, median_salary double, "
    "p75_salary double, global_median_salary double, salary_premium_pct double"
)


@pytest.mark.parametrize(
    "row, failing",
    [
        (("Go", 2021, 10, 4e4, 5e4, 6e4, 4e4, 25.0), []),
        (("Go", 2021, 10, 4e4, 5e4, 6e4, 4e4, 26.0), []),
        (("Go", 2021, 9, 4e4, 5e4, 6e4, 4e4, 25.0), ["respondent_count_below_threshold (9)"]),
        (("Go", 2021, 10, 5.1e4, 5e4, 6e4, 4e4, 25.0), ["p25_greater_than_median (51000.0 > 50000.0)"]),
        (("Go", 2021, 10, 4e4, 5e4, 4.9e4, 4e4, 25.0), ["median_greater_than_p75 (50000.0 > 49000.0)"]),
        (("Go", 2021, 10, 1e4, 19999.0, 6e4, 19999.0, 0.0), ["median_salary_out_of_range ($19999.0)"]),
        (("Go", 2021, 10, 4e4, 5e4, 6e4, 4e4, 26.5), ["salary_premium_calculation_error"]),
    ],
)
def test_salary_mart(spark, row, failing):
    assert reasons(marts.check_salary_mart(spark.createDataFrame([row], PAY))) == failing


MOOD = (
    "technology_name string, year int, adoption_pct double, desire_pct double, desire_gap double, lifecycle_stage string"
)


@pytest.mark.parametrize(
    "row, failing",
    [
        (("Go", 2021, 10.0, 15.0, 5.0, "emerging"), []),
        (("Go", 2021, 10.0, 15.0, 5.6, "emerging"), ["desire_gap_calculation_error (actual=5.6, expected=5.0)"]),
        (("Go", 2021, 101.0, 10.0, -91.0, "declining"), ["adoption_pct_out_of_bounds (101.0)"]),
        (("Go", 2021, 10.0, -1.0, -11.0, "declining"), ["desire_pct_out_of_bounds (-1.0)"]),
        (("Go", 2021, 10.0, 5.0, -5.0, "growing_interest"), ["lifecycle_inconsistent_with_desire_gap"]),
        (("Go", 2021, 10.0, 15.0, 5.0, "established_but_waning"), ["lifecycle_inconsistent_with_desire_gap"]),
    ],
)
def test_sentiment_mart(spark, row, failing):
    df = spark.createDataFrame([row], MOOD)
    assert reasons(marts.check_sentiment_mart(df)) == failing
    if not failing:
        assert reasons(marts.check_sentiment_mart(df.union(df))) == ["duplicate_primary_key"]


def test_run_checks_counts_failures(spark, rows):
    assert sum(len(c) for c in marts.DECLARED_CHECKS.values()) == 64
    df = spark.createDataFrame([("Go", 2021, 10.0, 15.0, 5.0, "emerging"), ("Go", 2031, 10.0, 15.0, 5.0, "odd")], MOOD)
    got = {r.test_name: (r.status, r.failure_count) for r in marts.run_checks({"technology_sentiment": df}).collect()}
    assert len(got) == 12
    assert {n for n, (s, _) in got.items() if s == "fail"} == {"accepted_values_year", "accepted_values_lifecycle_stage"}


def loaded(spark, name, kind, hours, limits):
    at = dt.datetime(2024, 3, 10) - dt.timedelta(hours=hours)
    table = spark.createDataFrame([(2023, at), (2022, at - dt.timedelta(days=9))], "survey_year int, _loaded_at timestamp_ntz")
    return freshness.FreshnessSource(name, kind, table, F.col("survey_year"), "_loaded_at", limits)


@pytest.mark.parametrize(
    "hours, limits, status",
    [
        (71, (72, 168), "OK"), (72, (72, 168), "WARNING"), (167, (72, 168), "WARNING"), (168, (72, 168), "CRITICAL"),
        (719, (720, 1440), "OK"), (720, (720, 1440), "WARNING"), (1439, (720, 1440), "WARNING"), (1440, (720, 1440), "CRITICAL"),
    ],
)
def test_freshness_limits(spark, hours, limits, status):
    as_of = F.lit("2024-03-10").cast("timestamp_ntz")
    row = freshness.freshness_status([loaded(spark, "s", "k", hours, limits)], as_of).first()
    assert (row.hours_since_load, row.freshness_status, row.latest_year, row.year_count, row.total_rows) == (hours, status, 2023, 2, 2)


def test_freshness_order_text_and_summary(spark):
    as_of = F.lit("2024-03-10").cast("timestamp_ntz")
    sources = [loaded(spark, n, "k", h, (72, 168)) for n, h in (("b", 1), ("a", 2), ("c", 200), ("d", 80))]
    status = freshness.freshness_status(sources, as_of)
    got = status.collect()
    assert [r.source_name for r in got] == ["c", "d", "a", "b"]
    assert got[0].message == "Data is 9 days old — exceeds critical threshold"
    assert got[1].message == "Data is 4 days old — exceeds warning threshold"
    assert got[2].message == "Data is fresh (2 hours old)"
    summary = freshness.freshness_summary(status).first()
    assert tuple(summary)[:3] == (1, 1, 2) and summary.overall_status.startswith("ACTION REQUIRED")
    warned = freshness.freshness_summary(status.where("freshness_status <> 'CRITICAL'")).first()
    assert warned.overall_status == "ATTENTION: freshness warnings detected"
    fresh = freshness.freshness_summary(status.where("freshness_status = 'OK'")).first()
    assert fresh.overall_status == "All sources are fresh"


OLD, NEW = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 8)


def log(spark, *lines):
    rows = [("r", at, m, t, None, s, n, sev, 5, None) for at, m, t, s, n, sev in lines]
    return spark.createDataFrame(rows, CHECK_LOG)


def test_dashboard(spark, rows):
    lines = log(
        spark, (OLD, "m", "t", "fail", 9, "error"), (NEW, "m", "t1", "pass", 0, "error"), (NEW, "m", "t2", "warn", 2, "error"),
        (NEW, "n", "t1", "pass", 0, "error"),
    )
    fresh = spark.createDataFrame([("n", 72), ("o", 168), ("p", 169)], "model_name string, hours_since_load int")
    fresh = fresh.withColumn("last_loaded_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    got = rows(
        dashboard.quality_dashboard(lines, fresh), "model_name", "total_tests", "pass_rate_pct", "total_failure_rows",
        "health_status", "freshness_status",
    )
    assert got == [
        ("m", 2, 50.0, 2, "critical", "unknown"), ("n", 1, 100.0, 0, "healthy", "fresh"),
        ("o", None, None, None, "untested", "stale"), ("p", None, None, None, "untested", "very_stale"),
    ]


def test_details_and_trends(spark):
    lines = log(
        spark, (OLD, "m", "t", "fail", 9, "error"), (NEW, "m", "c", "pass", 0, "error"), (NEW, "m", "b", "warn", 2, "error"),
        (NEW, "n", "a", "fail", 1, "warn"), (NEW, "z", "a", "fail", 1, "error"),
    )
    details = dashboard.quality_details(lines).collect()
    assert [(r.priority, r.model_name) for r in details] == [("P1", "z"), ("P2", "n"), ("P3", "m"), ("OK", "m")]
    trends = dashboard.quality_trends(lines).collect()
    assert [(r.model_name, r.run_date.day, r.pass_rate_pct) for r in trends][:2] == [("m", 2, 50.0), ("m", 1, 0.0)]


def test_report_totals(spark, rows):
    mixed = log(spark, *[(NEW, "m" if i < 5 else "n", str(i), "fail" if i == 0 else "pass", 0, "error") for i in range(10)])
    total = dashboard.report_totals(mixed).first()
    assert (total.total_tests, total.failed_tests, total.pass_rate_pct, total.overall) == (10, 1, 90.0, "DEGRADED")
    assert rows(dashboard.report_summary(mixed)) == [("m", 80.0, 1, False), ("n", 100.0, 0, True)]
    empty = dashboard.report_totals(mixed.where("false")).first()
    assert (empty.pass_rate_pct, empty.overall) == (0.0, "CRITICAL")


@pytest.mark.parametrize(
    "line, expected",
    [
        (
            "PASS not_null_fct_technology_adoption_technology_name ........................ [PASS in 0.85s]",
            ("fct_technology_adoption", "not_null", "name", "pass", 0, 850),
        ),
        (
            "09:00 FAIL unique_combination_of_columns_fct_said_vs_did .......................... [FAIL 3 in 1.2s]",
            ("fct_said_vs", "unique", "did", "fail", 3, 1200),
        ),
        ("WARN dim_check ... [WARN 12 in 2s]", ("dim_check", "custom", None, "warn", 12, 2000)),
        ("PASS accepted_range_x_stg_a ... [PASS in 0.1s]", ("stg_a", "accepted_range", "a", "pass", 0, 100)),
        ("PASS relationships_no_marker_here_at_all ... [PASS in 0.1s]", ("relationships_no_marker", "relationships", "all", "pass", 0, 100)),
        ("Finished running 3 tests", None),
        ("PASS incomplete", None),
    ],
)
def test_parse_check_log(spark, line, expected):
    lines = spark.createDataFrame([(line,)], "value string")
    got = logparse.parse_check_log(lines, F.lit("id"), F.lit("2024-01-01").cast("timestamp_ntz")).collect()
    if expected is None:
        assert got == []
    else:
        r = got[0]
        assert (r.model_name, r.test_type, r.column_name, r.status, r.failure_count, r.execution_ms) == expected
        assert r.severity == "error" and r.run_id == "id"
