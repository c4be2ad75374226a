"""Table listings and previews."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    """Names of the stored tables of a schema, sorted; views are left out."""
    names = spark.sql(f"SHOW TABLES IN {schema}").where(~F.col("isTemporary"))
    views = spark.sql(f"SHOW VIEWS IN {schema}").select(F.col("viewName").alias("tableName"))
    return (
        names.join(views, "tableName", "left_anti")
        .select(F.col("tableName").alias("table_name"))
        .orderBy("table_name")
    )


def list_columns(df: DataFrame) -> list[str]:
    return df.columns


def sample_table(df: DataFrame, n: int = 50, order: str = "none") -> DataFrame:
    """First `n` rows: in no order, by `_loaded_at` descending where that column exists, or by
    the first column."""
    if order == "loaded":
        loaded = [c for c in df.columns if c.lower() == "_loaded_at"]
        if loaded:
            df = df.orderBy(F.col(loaded[0]).desc_nulls_first())
    elif order == "first_column":
        df = df.orderBy(F.col(f"`{df.columns[0]}`").asc_nulls_last())
    elif order != "none":
        raise ValueError(f"unknown order {order!r}")
    return df.limit(n)


def load_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per value of `key`, in key order."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).orderBy(key)


def source_counts(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows per source."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("source"), "row_count")
        for n, df in sources.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def activity_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows and events per language, or per year with `key='activity_year'`."""
    keyed = df.withColumn("activity_year", F.year("activity_month"))
    return keyed.groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("event_count").alias("events")
    )


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The `n` most frequent non-NULL values; ties by value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), F.asc(column))
        .limit(n)
    )


def table_extent(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """Rows of a parquet table, and per column the smallest and largest value and how many are
    filled, from the files' footers: no row is read.

    For whole numbers, doubles, days and booleans; footers may cut the extremes of texts, and lack
    those of timestamps.  The reader that can do so is asked for in a session of its own, so that
    the caller's settings stay as they are."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    kept = [F.expr("count(*) AS total_rows")]
    for c in columns:
        name = "`" + c.replace("`", "``") + "`"
        kept += [F.expr(f"{kind}({name})").alias(f"{kind}_{c}") for kind in ("min", "max", "count")]
    return session.read.parquet(path).agg(*kept)
