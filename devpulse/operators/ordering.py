"""Orders and top-k.  NULL placement and tie keys are always stated."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rank_of(column: str, ranks: Sequence[str]) -> Column:
    """Position of the value in `ranks`; anything else comes last."""
    position = F.lit(len(ranks) + 1)
    for i, value in reversed(list(enumerate(ranks, start=1))):
        position = F.when(F.col(column) == value, i).otherwise(position)
    return position


def order_by_rank(
    df: DataFrame, column: str, ranks: Sequence[str], then: Sequence[str]
) -> DataFrame:
    return df.orderBy(rank_of(column, ranks), *[F.asc_nulls_last(c) for c in then])


def order_by_abs(
    df: DataFrame, column: str, then: Sequence[Column] = (), nulls_first: bool = False
) -> DataFrame:
    """Largest magnitude first."""
    size = F.abs(F.col(column))
    leading = size.desc_nulls_first() if nulls_first else size.desc_nulls_last()
    return df.orderBy(leading, *then)


def top_k(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First `n` rows of an order.  Spark keeps `n` rows per task and merges them."""
    return df.orderBy(*order).limit(n)


def row_at_max(df: DataFrame, value: str, columns: Sequence[str], tie: str) -> DataFrame:
    """The row with the largest `value`; among equals the first by `tie`."""
    rows = df.where(F.col(value).isNotNull())
    return top_k(rows, [F.desc(value), F.asc(tie)], 1).select(*columns)


def first_last(df: DataFrame, value: str, name: str) -> DataFrame:
    """Top and bottom of a ranking (largest `value` first, then `name`), side by side."""
    place = F.struct((-F.col(value)).alias("v"), F.col(name).alias("n"))
    first, last = F.min(place), F.max(place)
    return df.where(F.col(value).isNotNull()).agg(
        first["n"].alias(f"top_{name}"),
        (-first["v"]).alias(f"top_{value}"),
        last["n"].alias(f"bottom_{name}"),
        (-last["v"]).alias(f"bottom_{value}"),
    )


def sort_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(k) for k in keys])
