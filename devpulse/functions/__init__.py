from devpulse.functions.keys import surrogate_key
from devpulse.functions.scalars import (
    clamp,
    contains_any,
    days_between,
    first_non_blank,
    hours_between,
    null_if_token,
    ordered_text,
    pct_of_total,
    ratio,
    round_half_away,
    split_text,
    strip_quotes,
    to_double,
    to_whole_number,
)

__all__ = [
    "clamp",
    "contains_any",
    "days_between",
    "first_non_blank",
    "hours_between",
    "null_if_token",
    "ordered_text",
    "pct_of_total",
    "ratio",
    "round_half_away",
    "split_text",
    "strip_quotes",
    "surrogate_key",
    "to_double",
    "to_whole_number",
]
