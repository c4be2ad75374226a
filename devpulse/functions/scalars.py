"""Column helpers.  All of them are built-in Spark expressions, so they stay in the JVM."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from devpulse.constants import NULL_TOKENS

WHITESPACE = " \t\n\r\x0b\x0c"


def round_half_away(value: Column, digits: int = 0) -> Column:
    """Round a double half away from zero after scaling it.

    Spark's own `round(x, d)` works on the shortest decimal text of x, which differs from
    warehouse engines at ties such as 1.005; scaling first gives their answer.
    """
    scale = float(10**digits)
    scaled = value.cast("double") * F.lit(scale)
    return F.round(scaled) / F.lit(scale)


def pct_of_total(part: Column, total: Column) -> Column:
    """`part` as a percentage of `total`, two digits, NULL for an empty total.

    Counts are whole numbers, so the rounding is done in whole numbers and is exact."""
    part = part.cast("decimal(20,0)")
    total = F.nullif(total.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(part * F.lit(100) / total, 2).cast("double")


def ratio(part: Column, total: Column) -> Column:
    """part / total as a double, NULL when the total is zero."""
    return part.cast("double") / F.nullif(total.cast("double"), F.lit(0.0))


def to_whole_number(text: Column) -> Column:
    """Text to a 38-digit whole number, rounding half away from zero; NULL when it is no number."""
    return F.trim(text).try_cast("decimal(38,0)")


def to_double(text: Column) -> Column:
    """Text to a double; NULL when it is no number."""
    return text.cast("string").try_cast("double")


def null_if_token(text: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~text.isin(list(tokens)), text)


def strip_quotes(text: Column) -> Column:
    """Trim whitespace, then surrounding double quotes; an empty result is NULL."""
    bare = F.btrim(F.btrim(text, F.lit(WHITESPACE)), F.lit('"'))
    return F.when(bare != "", bare)


def first_non_blank(values: Column) -> Column:
    """First element of an array, NULL when there is none."""
    return F.try_element_at(values, F.lit(1))


def contains_any(text: Column, needles: Sequence[str]) -> Column:
    """True when `text` holds one of `needles`, ignoring case; NULL text gives False."""
    lowered, found = F.lower(text), F.lit(False)
    for needle in needles:
        found = found | F.contains(lowered, F.lit(needle.lower()))
    return F.coalesce(found, F.lit(False))


def split_text(text: Column, separator: str) -> Column:
    """Split at a literal separator.  Only characters that mean something in a pattern are
    escaped: a one-character separator then needs no pattern to be compiled per row."""
    literal = "".join("\\" + c if c in r".$|()[{^?*+\\" else c for c in separator)
    return F.split(text, literal)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed between two timestamps."""
    return F.datediff(F.to_date(end), F.to_date(start))


def hours_between(start: Column, end: Column) -> Column:
    """Full hours crossed on the clock, so 00:59 to 01:01 counts as one."""
    return days_between(start, end) * 24 + F.hour(end) - F.hour(start)


def ordered_text(order: Column, text: Column, separator: str = ", ") -> Column:
    """Aggregate: the texts of a group, ordered by `order` and joined; NULL texts are left out."""
    pairs = F.collect_list(F.when(text.isNotNull(), F.struct(order.alias("o"), text.alias("t"))))
    return F.array_join(F.transform(F.array_sort(pairs), lambda p: p["t"]), separator)
