"""Grouped aggregates.

Each one combines on the map side first, so a group that holds a large share of the input
arrives at its reducer as one partial row per task.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devpulse.functions import round_half_away
from devpulse.operators.quantiles import group_quantiles


def respondent_totals(
    surveys: DataFrame,
    respondent: Sequence[str] = ("survey_response_id",),
    year: str = "survey_year",
) -> DataFrame:
    """Distinct respondents per year."""
    within = [c for c in respondent if c != year]
    return surveys.groupBy(year).agg(F.count_distinct(*within).alias("total_respondents"))


def adoption_counts(
    rows: DataFrame,
    counts: Mapping[str, str],
    respondent: Sequence[str] = ("survey_response_id",),
    keys: Sequence[str] = (
        "survey_year",
        "technology_name",
        "technology_category",
        "technology_subcategory",
    ),
) -> DataFrame:
    """Distinct respondents per key that set each flag (`counts`: output column -> flag).

    Flags are first combined per key and respondent, then counted; several distinct counts in
    one grouping would make Spark copy every row once per count."""
    within = [*keys, *[c for c in respondent if c not in keys]]
    per_respondent = rows.groupBy(*within).agg(
        *[F.bool_or(flag).alias(flag) for flag in counts.values()]
    )
    return per_respondent.groupBy(*keys).agg(
        *[F.count_if(F.col(flag)).alias(name) for name, flag in counts.items()]
    )


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, percentiles: Mapping[str, float]
) -> DataFrame:
    """Exact, interpolated percentiles per key, of values of any domain.

    By selection: no task holds a group's values, not even its distinct ones.  Keys without a
    value have no row."""
    return group_quantiles(df, keys, value, percentiles)


def weighted_percentiles(
    counted: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    percentiles: Mapping[str, float],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Percentiles of values that come with a count, plus further aggregates of the group.

    One pass; a group's reducer holds a weighted row per distinct value, so use it where the
    domain has a bound (whole-number pay, rounded medians), else `exact_percentiles`."""
    points = F.percentile(
        F.col(value), F.array(*[F.lit(p) for p in percentiles.values()]), F.col(weight)
    )
    grouped = counted.groupBy(*keys).agg(points.alias("_points"), *extra)
    return grouped.select(
        *[c for c in grouped.columns if c != "_points"],
        *[F.col("_points")[i].alias(name) for i, name in enumerate(percentiles)],
    )


def salary_stats(
    df: DataFrame,
    keys: Sequence[str],
    pay: str = "compensation_total",
    accuracy: int | None = None,
) -> DataFrame:
    """Count, mean, quartiles (rounded to whole units), minimum and maximum of pay per key.

    Pay is a whole number in a bounded range, so counting equal amounts first bounds what one
    group can hold.  `accuracy` swaps the exact percentiles for sketches of that accuracy."""
    amount = F.col("_pay")
    paid = df.withColumn("_pay", F.col(pay).cast("long"))
    points = {"median_salary": 0.5, "p25_salary": 0.25, "p75_salary": 0.75}
    if accuracy is None:
        counted = paid.groupBy(*keys, "_pay").agg(F.count(F.lit(1)).alias("_n"))
        people = F.sum("_n")
        total = F.sum(amount.cast("decimal(20,0)") * F.col("_n").cast("decimal(18,0)"))
        stats = weighted_percentiles(
            counted,
            keys,
            "_pay",
            "_n",
            points,
            [
                people.alias("respondent_count"),
                (total.cast("double") / people).alias("avg_salary"),
                F.min("_pay").alias("min_salary"),
                F.max("_pay").alias("max_salary"),
            ],
        )
    else:
        sketch = F.percentile_approx("_pay", list(points.values()), accuracy)
        stats = (
            paid.groupBy(*keys)
            .agg(
                F.count(F.lit(1)).alias("respondent_count"),
                F.avg("_pay").alias("avg_salary"),
                F.min("_pay").alias("min_salary"),
                F.max("_pay").alias("max_salary"),
                sketch.alias("_points"),
            )
            .select(
                "*", *[F.col("_points")[i].alias(name) for i, name in enumerate(points)]
            )
        )
    rounded = ["avg_salary", "median_salary", "p25_salary", "p75_salary"]
    return stats.select(
        *keys,
        "respondent_count",
        *[round_half_away(F.col(c)).alias(c) for c in rounded],
        "min_salary",
        "max_salary",
    )


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def groups_having(df: DataFrame, keys: Sequence[str], minimum: int = 2) -> DataFrame:
    """Keys with at least `minimum` rows, and how many."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") >= minimum)
    )


def distinct_names(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def survey_average(adoption: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Mean adoption and best desire over the surveys, per year and technology."""
    return (
        filter_sources(adoption, sources, "survey_adoption_pct")
        .groupBy("year", "technology_name", "technology_category")
        .agg(
            F.avg("survey_adoption_pct").alias("avg_survey_adoption_pct"),
            F.max("survey_desire_pct").alias("max_survey_desire_pct"),
        )
    )


def filter_sources(df: DataFrame, sources: Sequence[str], metric: str | None = None) -> DataFrame:
    """Rows of the given sources, and with a value in `metric`."""
    rows = df.where(F.col("data_source").isin(list(sources)))
    return rows if metric is None else rows.where(F.col(metric).isNotNull())


def filter_domains(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-NULL values of a column, as offered by a selector."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def mean_over_sources(df: DataFrame, value: str = "survey_adoption_pct") -> DataFrame:
    return df.groupBy("year", "technology_name", "technology_category").agg(
        F.avg(value).alias(value)
    )


def top_n_by_mean(
    df: DataFrame, n: int, value: str = "survey_adoption_pct", key: str = "technology_name"
) -> DataFrame:
    """The `n` keys with the largest mean; ties by key."""
    return (
        df.groupBy(key)
        .agg(F.avg(value).alias("mean_value"))
        .orderBy(F.desc_nulls_last("mean_value"), F.asc(key))
        .limit(n)
    )


def plain(value: Column, kind: T.DataType) -> Column:
    """A value whose text is the same wherever the value is: no negative zero, no raw bytes."""
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    return value + F.lit(0.0) if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else value


# aggregates that partial results can be put together by, and what does
COMBINED = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}


def grouped_distinct_counts(
    df: DataFrame,
    keys: Sequence[str],
    others: Mapping[str, tuple[str, str]],
    counted: Mapping[str, str],
) -> DataFrame:
    """Exact distinct counts (`counted`: column by name of its count) and further aggregates
    (`others`: (count, sum, min or max; column, or * to count rows) by name) per key.

    The input is read once, however many columns are counted.  Each row gives one entry a counted
    column, and the first also carries what `others` need.  Whole numbers and dates are counted in
    bitmaps of 64 values, which tasks combine before anything is shuffled, so a dense column
    shuffles a word for 64 values and a sparse one a word a value; other types shuffle their
    distinct values."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    whole = {c: isinstance(kinds[c], (T.IntegralType, T.DateType)) for c in counted.values()}
    wanted = [(f"_o{i}", kind, column) for i, (kind, column) in enumerate(others.values())]
    kinds["*"] = T.IntegerType()
    entries = []
    for i, column in enumerate(counted.values()):
        number = F.unix_date(column) if isinstance(kinds[column], T.DateType) else F.col(column).cast("long")
        number = number.cast("long")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(64)).cast("int"))
        entries.append(
            F.struct(
                F.lit(i).alias("_which"),
                (F.shiftright(number, 6) if whole[column] else F.lit(None).cast("long")).alias("_word"),
                (F.lit(None) if whole[column] else plain(F.col(column), kinds[column])).cast("string").alias("_value"),
                (bit if whole[column] else F.lit(1).cast("long")).alias("_bit"),
                *[
                    (F.lit(1) if c == "*" else F.col(c) if i == 0 else F.lit(None).cast(kinds[c])).alias(o)
                    for o, _, c in wanted
                ],
            )
        )
    rows = df.select(*keys, F.inline(F.array(*entries)))
    words = rows.groupBy(*keys, "_which", "_word", "_value").agg(
        F.bit_or("_bit").alias("_bits"), *[F.expr(f"{kind}({o}) AS {o}") for o, kind, _ in wanted]
    )
    first = F.col("_which") == 0
    filled = F.col("_word").isNotNull() | F.col("_value").isNotNull()
    found = F.when(filled, F.bit_count("_bits")).otherwise(0)
    return words.groupBy(*keys).agg(
        *[
            F.call_function(COMBINED[kind], F.when(first, F.col(o))).alias(name)
            for name, (o, kind, _) in zip(others, wanted, strict=True)
        ],
        *[
            F.coalesce(F.sum(F.when(F.col("_which") == i, found)), F.lit(0)).cast("long").alias(name)
            for i, name in enumerate(counted)
        ],
    )
