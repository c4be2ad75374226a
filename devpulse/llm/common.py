"""What the corpus operators share: reading text as words, splitting documents for learning and
holding back, and tables that several steps read.

Null texts count as empty everywhere.  Only the columns an operator names are read, so extra
columns of any name do no harm."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devpulse.sources.sinks import CHECKPOINT_DIR, cut_lineage


def stored(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder and read back.  Operators that read a table
    several times, or go in rounds, don't work without that folder: each round would repeat all
    before it, and a lost executor would have it repeated again."""
    out = cut_lineage(df)
    if out is df:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return out


# rows of two or three numbers that are sent to all tasks instead of a shuffle, at most
SENT = 1_000_000


def sent(df: DataFrame) -> DataFrame:
    """A stored table of keys, marked to be sent to all tasks if it has at most SENT rows."""
    return F.broadcast(df) if df.count() <= SENT else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_column(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fold(parts: int, column: str = "doc_id") -> Column:
    """The part of `parts` a document belongs to, by CRC-32 of its id in decimal; null stays null."""
    return F.crc32(F.col(column).cast("string")) % parts


def words(data: bytes) -> list[bytes]:
    """Words of UTF-8 text between blanks and control blanks, A-Z in lower case."""
    return data.lower().split()


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learned: Column, most: int
) -> DataFrame:
    """(text, label) of at most `most` documents whose label may be learned: those of smallest id
    hash.  Of labels that contradict the larger counts, null ones do not."""
    known = (
        labels.where(F.col(label).isNotNull() & learned)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label).cast("int").alias(label))
    )
    some = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    texts = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    # the sample has a bound, so the texts stay where they are
    return texts.join(F.broadcast(some), "doc_id").select("text", label)


def utf8(column: pa.Array) -> list[bytes]:
    """An Arrow text column as bytes, nulls as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that lists made from a batch stay small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def batch(schema: pa.Schema, columns: dict[str, object]) -> pa.RecordBatch:
    """A record batch from lists or arrays by name."""
    return pa.RecordBatch.from_arrays(
        [
            columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
            for f in schema
        ],
        schema=schema,
    )
