import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from devpulse import functions as fn


def one(spark, column, value=None, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(column.alias("r")).first().r


@pytest.mark.parametrize(
    "text, number",
    [("12.5", 13), ("-2.5", -3), (" 7 ", 7), ("60000.5", 60001), ("abc", None), ("", None), (None, None)],
)
def test_to_whole_number(spark, text, number):
    got = one(spark, fn.to_whole_number(F.col("v")), text)
    assert got == number


@pytest.mark.parametrize(
    "value, digits, rounded",
    [(2.5, 0, 3.0), (-2.5, 0, -3.0), (12.345, 2, 12.35), (1.004, 2, 1.0), (None, 2, None)],
)
def test_round_half_away(spark, value, digits, rounded):
    assert one(spark, fn.round_half_away(F.col("v"), digits), value, "v double") == rounded


@pytest.mark.parametrize("part, total, pct", [(1, 3, 33.33), (2469, 20000, 12.35), (0, 5, 0.0), (5, 0, None)])
def test_pct_of_total(spark, part, total, pct):
    df = spark.createDataFrame([(part, total)], "p long, t long")
    assert df.select(fn.pct_of_total(F.col("p"), F.col("t"))).first()[0] == pct


@pytest.mark.parametrize(
    "start, end, hours, days",
    [
        ("2024-01-01 00:59:00", "2024-01-01 01:01:00", 1, 0),
        ("2024-01-01 00:01:00", "2024-01-01 00:59:00", 0, 0),
        ("2023-12-31 23:59:00", "2024-01-01 00:00:00", 1, 1),
        ("2024-01-03 00:00:00", "2024-01-01 12:00:00", -36, -2),
    ],
)
def test_boundaries_between(spark, start, end, hours, days):
    df = spark.createDataFrame([(start, end)], "a string, b string").select(
        *[F.col(c).cast("timestamp_ntz") for c in "ab"]
    )
    a, b = F.col("a"), F.col("b")
    assert tuple(df.select(fn.hours_between(a, b), fn.days_between(a, b)).first()) == (hours, days)


def test_surrogate_key_tells_null_from_blank(spark):
    df = spark.createDataFrame([("a", 2021), (None, 2021), ("", 2021)], "r string, y int")
    keys = [r[0] for r in df.select(fn.surrogate_key("r", "y")).collect()]
    texts = ["a-2021", "_dbt_utils_surrogate_key_null_-2021", "-2021"]
    assert keys == [hashlib.md5(t.encode()).hexdigest() for t in texts]


def test_text_helpers(spark):
    assert one(spark, fn.strip_quotes(F.col("v")), '\t " x" ') == " x"
    assert one(spark, fn.strip_quotes(F.col("v")), ' "" ') is None
    assert one(spark, fn.null_if_token(F.col("v")), "NA") is None
    assert one(spark, fn.null_if_token(F.col("v")), "na") == "na"
    assert one(spark, fn.contains_any(F.col("v"), ["engineer, DATA"]), "x;Engineer, data;y") is True
    assert one(spark, fn.contains_any(F.col("v"), ["c++"]), "C++ and C") is True
    assert one(spark, fn.contains_any(F.col("v"), ["x"]), None) is False


def test_numbers_and_lists(spark):
    assert one(spark, fn.clamp(F.col("v"), 0.4, 1.0), 0.1, "v double") == 0.4
    assert one(spark, fn.clamp(F.col("v"), 0.4, 1.0), 7.0, "v double") == 1.0
    assert one(spark, fn.to_double(F.col("v")), "1e3") == 1000.0
    assert one(spark, fn.ratio(F.col("v"), F.lit(0)), 3, "v int") is None
    assert one(spark, fn.first_non_blank(F.array(F.col("v"))), "a") == "a"
    assert one(spark, fn.first_non_blank(F.array().cast("array<string>"))) is None
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "o int, t string")
    assert df.agg(fn.ordered_text(F.col("o"), F.col("t"))).first()[0] == "a, b"


def test_dates_are_dates(spark):
    assert one(spark, F.trunc(F.col("v").cast("date"), "year"), "2024-05-06") == dt.date(2024, 1, 1)
