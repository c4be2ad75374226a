"""Survey B files: one column per answer option, folded back into lists."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.constants import (
    DUPLICATE_HEADER_SUFFIX,
    LIST_SEPARATOR,
    META_ANSWERS_ANY_CASE,
    META_ANSWERS_EXACT_CASE,
    PRIMARY_PREFIX_COLON_2023,
    PRIMARY_PREFIX_COLON_2024,
    PRIMARY_PREFIX_DOT,
    SURVEY_B_FIELDS_COLON,
    SURVEY_B_FIELDS_DOT,
    WIDE_PREFIXES_COLON,
    WIDE_PREFIXES_DOT,
)
from devpulse.functions import first_non_blank
from devpulse.functions.scalars import WHITESPACE
from devpulse.sources.schemas import SURVEY_B, conform


def quoted(header: str) -> str:
    """A header as a column name, whatever is in it."""
    return "`" + header.replace("`", "``") + "`"


def selected_options(
    df: DataFrame, prefix: str, drop_answers: bool = False, drop_suffix: str | None = None
) -> Column:
    """Array of the non-blank cells under headers that start with `prefix`, in file order.

    All options of a question become one array expression, so thousands of headers do not
    make thousands of plan nodes."""
    headers = [
        h
        for h in df.columns
        if h.startswith(prefix) and not (drop_suffix and h.endswith(drop_suffix))
    ]
    if not headers:
        return F.array().cast("array<string>")
    raw = F.array(*[F.col(quoted(h)) for h in headers])
    cells = F.transform(raw, lambda cell: F.btrim(cell, F.lit(WHITESPACE)))

    def keep(cell: Column) -> Column:
        wanted = cell.isNotNull() & (cell != "")
        if drop_answers:
            for text in META_ANSWERS_EXACT_CASE:
                wanted = wanted & ~F.contains(cell, F.lit(text))
            for text in META_ANSWERS_ANY_CASE:
                wanted = wanted & ~F.contains(F.lower(cell), F.lit(text))
        return wanted

    return F.filter(cells, keep)


def joined_or_null(options: Column) -> Column:
    return F.when(F.size(options) > 0, F.array_join(options, LIST_SEPARATOR))


def collect_wide_multiselect(
    df: DataFrame,
    prefix: str,
    fallback: str | None = None,
    drop_answers: bool = False,
    drop_suffix: str | None = None,
) -> Column:
    """The selected options as one ';' list, NULL if none; with `fallback`, a second prefix is
    used for the rows where the first gave nothing."""
    text = joined_or_null(selected_options(df, prefix, drop_answers, drop_suffix))
    if fallback is None:
        return text
    other = joined_or_null(selected_options(df, fallback, drop_answers, drop_suffix))
    return F.coalesce(text, other)


def first_selected(
    df: DataFrame, prefix: str, drop_answers: bool = False, drop_suffix: str | None = None
) -> Column:
    return first_non_blank(selected_options(df, prefix, drop_answers, drop_suffix))


def first_present_field(df: DataFrame, names: Sequence[str]) -> Column:
    """The first header that exists in the file (not the first value that is filled)."""
    for name in names:
        if name in df.columns:
            return F.col(quoted(name))
    return F.lit(None).cast("string")


def load_wide_survey(df: DataFrame, year: int, require_id: bool = True) -> DataFrame:
    """One year of survey B in the raw table's shape.

    A file without a respondent id would collapse all its respondents into one; that is an
    error here unless `require_id` is turned off."""
    if require_id and "response_id" not in df.columns:
        raise ValueError(f"survey file of {year} has no response_id header")
    dotted = year <= 2022
    fields: Mapping[str, Sequence[str]] = SURVEY_B_FIELDS_DOT if dotted else SURVEY_B_FIELDS_COLON
    prefixes = WIDE_PREFIXES_DOT if dotted else WIDE_PREFIXES_COLON
    if dotted:
        primary = PRIMARY_PREFIX_DOT
    else:
        primary = PRIMARY_PREFIX_COLON_2023 if year == 2023 else PRIMARY_PREFIX_COLON_2024
    cleaning = {
        "drop_answers": dotted,
        "drop_suffix": DUPLICATE_HEADER_SUFFIX if dotted else None,
    }
    lists = {
        target: collect_wide_multiselect(df, names[0], *names[1:], **cleaning)
        for target, names in prefixes.items()
    }
    row = df.select(
        F.lit(year).cast("int").alias("survey_year"),
        *[first_present_field(df, names).alias(c) for c, names in fields.items()],
        first_selected(df, primary, **cleaning).alias("primary_language"),
        *[c.alias(name) for name, c in lists.items()],
    )
    return conform(row, SURVEY_B)
