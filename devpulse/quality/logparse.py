"""Text of a check run to result rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.constants import CHECK_LINE, CHECK_NAME_PREFIXES, CHECK_TYPES, MODEL_MARKERS


def _first_words(name: Column, n: int = 3) -> Column:
    return F.substring_index(name, "_", n)


def model_of(name: Column) -> Column:
    """Model in a check name: three words from the first marker that follows a known prefix,
    else the first three words of the name."""
    guesses = []
    for prefix in CHECK_NAME_PREFIXES:
        rest = F.substr(name, F.lit(len(prefix) + 1))
        for marker in MODEL_MARKERS:
            at = F.instr(rest, marker)
            guesses.append(
                F.when(
                    name.startswith(prefix) & (at > 0),
                    _first_words(F.substr(rest, at)),
                )
            )
    return F.coalesce(*guesses, _first_words(name))


def column_of(name: Column) -> Column:
    """Last word of a check name of more than four words."""
    words = F.split(name, "_")
    return F.when(F.size(words) > 4, F.element_at(words, -1))


def type_of(name: Column) -> Column:
    kind = F.lit("custom")
    for candidate in reversed(CHECK_TYPES):
        kind = F.when(name.startswith(candidate), candidate).otherwise(kind)
    return kind


def parse_check_log(
    lines: DataFrame, run_id: Column, run_at: Column, column: str = "value"
) -> DataFrame:
    """Result rows from the lines of a check run; lines that are no result are skipped."""
    line = F.col(column)

    def part(i: int) -> Column:
        return F.regexp_extract(line, CHECK_LINE, i)

    name = F.col("test_name")
    failures = F.col("_failures")
    parsed = lines.where(line.rlike(CHECK_LINE)).select(
        F.lower(part(1)).alias("status"),
        part(2).alias("test_name"),
        part(4).alias("_failures"),
        part(5).alias("_seconds"),
    )
    return parsed.select(
        run_id.alias("run_id"),
        run_at.alias("run_at"),
        model_of(name).alias("model_name"),
        "test_name",
        type_of(name).alias("test_type"),
        column_of(name).alias("column_name"),
        "status",
        F.when(failures == "", F.lit(0)).otherwise(failures.try_cast("long")).cast("long").alias(
            "failure_count"
        ),
        F.lit("error").alias("severity"),
        F.floor(F.col("_seconds").try_cast("double") * 1000).cast("long").alias("execution_ms"),
    )
