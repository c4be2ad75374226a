"""Surrogate keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from devpulse.constants import KEY_NULL, KEY_SEPARATOR


def surrogate_key(*columns: str) -> Column:
    """md5 over the text of `columns`; a NULL contributes a fixed marker, so (NULL, 'a')
    and ('', 'a') get different keys."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(KEY_NULL)) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
