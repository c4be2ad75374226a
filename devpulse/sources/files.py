"""Delimited and event files."""

import csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devpulse.constants import ARCHIVE_EVENT_TYPES, NULL_TOKENS, SURVEY_A_HEADERS
from devpulse.functions import null_if_token, strip_quotes, to_whole_number
from devpulse.sources.records import quoted_rows
from devpulse.sources.schemas import SURVEY_A, conform
from devpulse.sources.sinks import path_exists


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    sep: str = ",",
    null_tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = False,
    rejected: bool = False,
    quoted_breaks: bool = False,
) -> DataFrame:
    """Quoted CSV with a header; columns are taken by position when a schema is given.

    Short rows are padded with NULL and long rows cut, so a wrong column count never loses a
    row.  A row whose text does not fit the type of a column is skipped; `rejected` gives these
    rows instead, as texts, with the columns that don't fit in `misfits`.  Files are split, so a
    line is a row; `quoted_breaks` allows line breaks inside quotes, with files split all the same
    and read twice, and `multi_line` allows them by making each file one task.
    """
    if quoted_breaks:
        raw = _split_rows(spark, path, schema, sep)
        return _cleaned(raw, schema, null_tokens, rejected)
    reader = spark.read.options(
        header=True, sep=sep, quote='"', escape='"', mode="PERMISSIVE", multiLine=multi_line
    )
    if schema is not None:
        reader = reader.schema(_texts(schema.names))
    return _cleaned(reader.csv(path), schema, null_tokens, rejected)


def _texts(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _split_rows(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None, sep: str
) -> DataFrame:
    """The rows of split files as texts; without a schema, under the first row of the first file."""
    rows = quoted_rows(spark, path)
    if schema is None:
        header = rows.where("first").orderBy("file").first()
        names = next(csv.reader([header["text"]], delimiter=sep)) if header else []
    else:
        names = schema.names
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    cells = F.from_csv("text", _texts([f"c{i}" for i in range(len(names))]).simpleString()[7:-1].replace(":", " "), options)
    parsed = rows.where(~F.col("first")).select(cells.alias("cells"))
    return parsed.select(*[F.col(f"cells.c{i}").alias(n) for i, n in enumerate(names)])


def _cleaned(
    raw: DataFrame, schema: T.StructType | None, null_tokens: Sequence[str], rejected: bool
) -> DataFrame:
    if schema is None:
        return raw.select(
            *[null_if_token(F.col(_quoted(c)), null_tokens).alias(c) for c in raw.columns]
        )
    present = {n: null_if_token(F.col(_quoted(n)), null_tokens) for n in schema.names}
    typed = {f.name: _typed(present[f.name], f.dataType) for f in schema.fields}
    misfits = F.filter(
        F.array(
            *[
                F.when(present[name].isNotNull() & value.isNull(), F.lit(name))
                for name, value in typed.items()
            ]
        ),
        lambda name: name.isNotNull(),
    )
    if rejected:
        return raw.select("*", misfits.alias("misfits")).where(F.size("misfits") > 0)
    fits = raw.where(F.size(misfits) == 0)
    return fits.select(*[value.alias(name) for name, value in typed.items()])


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.IntegralType):
        return to_whole_number(text).try_cast(kind)
    return F.trim(text).try_cast(kind)


def map_columns(df: DataFrame, mapping: Mapping[str, str], year: int) -> DataFrame:
    """Rename headers to table columns; unknown headers are dropped and, when two headers mean
    the same column, the one that comes first in the file is kept."""
    chosen: dict[str, str] = {}
    for header in df.columns:
        target = mapping.get(header.strip().strip('"'))
        if target is not None:
            chosen.setdefault(target, header)
    return df.select(
        F.lit(year).cast("int").alias("survey_year"),
        *[strip_quotes(F.col(_quoted(h))).alias(t) for t, h in chosen.items()],
    )


def load_survey_years(
    spark: SparkSession,
    files: Mapping[int, str],
    mapping: Mapping[str, str] = SURVEY_A_HEADERS,
    schema: T.StructType = SURVEY_A,
    quoted_breaks: bool = True,
) -> DataFrame:
    """The files of all years (path by year), each with headers of its own, as one raw table.

    Years whose file is missing are left out; columns that a year's file lacks are NULL.  The
    branches differ in headers alone, so nothing is shuffled."""
    found = [
        conform(map_columns(scan_csv(spark, path, quoted_breaks=quoted_breaks), mapping, year), schema)
        for year, path in sorted(files.items())
        if path_exists(spark, path)
    ]
    if not found:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def scan_events(
    spark: SparkSession,
    path: str,
    first_day: str,
    last_day: str,
    types: Sequence[str] = ARCHIVE_EVENT_TYPES,
    day_column: str = "day",
    type_column: str = "type",
    file_format: str = "parquet",
) -> DataFrame:
    """Events of the given kinds between two days, both included.

    With files laid out by `day_column` the day test prunes folders; the type test reaches the
    parquet reader."""
    return events_between(
        spark.read.format(file_format).load(path),
        first_day,
        last_day,
        types,
        day_column,
        type_column,
    )


def events_between(
    events: DataFrame,
    first_day: str,
    last_day: str,
    types: Sequence[str] = ARCHIVE_EVENT_TYPES,
    day_column: str = "day",
    type_column: str = "type",
) -> DataFrame:
    """The two tests of `scan_events` on a frame that is already read.  The bounds are cast to
    the column's own type, never the column, so the filter can be pushed down."""
    day_type = events.schema[day_column].dataType
    lower = F.lit(first_day).cast("date").cast(day_type)
    upper = F.date_add(F.lit(last_day).cast("date"), 1).cast(day_type)
    day = F.col(day_column)
    return events.where((day >= lower) & (day < upper) & F.col(type_column).isin(list(types)))
