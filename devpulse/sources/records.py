"""Rows of delimited text with line breaks inside quotes, from files that are split.

Whether a line begins a row depends on the quotes before it, all the way to the start of its file.
A first pass counts the quotes of each split; their running sum over a file's splits says whether a
split begins inside quotes.  A second pass then cuts each split into rows by itself.  Only the
pieces of rows that lie across splits, two a split at most, are brought together."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# splits up to this many (about 100 bytes each) are sent to all tasks; beyond, each split is cut in
# both ways and the pieces are joined
SENT_SPLITS = 200_000
# a piece is a whole row, goes on from an earlier split, or goes on into the next
WHOLE, ENDING, OPEN = 0, 1, 2
PIECES = "file string, start long, inside long, line long, kind int, text string"


class _Split:
    """A split being cut, on the assumption that it begins inside quotes or doesn't."""

    def __init__(self, file: str, start: int, inside: int):
        self.own = {"file": file, "start": start, "inside": inside}
        self.inside = self.ending = bool(inside)
        self.held: list[str] = []
        self.number = 0

    def row(self, kind: int) -> dict:
        return {**self.own, "line": self.number - len(self.held), "kind": kind, "text": "\n".join(self.held)}

    def add(self, text: str, flips: bool) -> Iterator[dict]:
        self.held.append(text)
        self.number += 1
        self.inside ^= flips
        if not self.inside:
            yield self.row(ENDING if self.ending else WHOLE)
            self.held, self.ending = [], False

    def rest(self) -> Iterator[dict]:
        if self.held:
            yield self.row(ENDING if self.ending else OPEN)


def _cutter(quote: str):
    """Lines of splits, each split's in order, to pieces of rows; a split whose beginning isn't
    known is cut in both ways."""
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in PIECES.split(", "))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ways = None, []
        for b in batches:
            out: list[dict] = []
            columns = [b[c].to_pylist() for c in ("file", "start", "text", "inside")]
            for file, start, text, inside in zip(*columns, strict=True):
                if (file, start) != at:
                    out += [r for w in ways for r in w.rest()]
                    at = (file, start)
                    ways = [_Split(file, start, i) for i in ((0, 1) if inside is None else (inside,))]
                flips = text.count(quote) % 2 == 1
                for way in ways:
                    out += way.add(text, flips)
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        yield pa.RecordBatch.from_pylist([r for w in ways for r in w.rest()], schema=schema)

    return cut


def quoted_rows(spark: SparkSession, path: str | list[str], quote: str = '"') -> DataFrame:
    """(file, first, text) of every row of the files: its text with its line breaks, and whether
    it is the file's first.  Blank rows are left out.

    A quote inside a quoted cell is written twice, which leaves the sum's parity as it is.  Rows
    end at line feeds; a carriage return before one goes."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("text"),
    )
    quotes = F.length("text") - F.length(F.replace("text", F.lit(quote), F.lit("")))
    splits = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        "file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("inside")
    )
    # a broadcast join keeps the lines of a split in order
    known = splits.count() <= SENT_SPLITS
    begun = F.lit(None).cast("long").alias("inside")
    read = lines.join(F.broadcast(splits), ["file", "start"]) if known else lines.select("*", begun)
    pieces = read.select("file", "start", "text", "inside").mapInArrow(_cutter(quote), PIECES)
    if not known:
        # each split has been cut in both ways; the one that its beginning asks for stays
        pieces = pieces.join(splits, ["file", "start", "inside"])
    # a row that is open at the end of a split goes on in the endings of the splits behind it
    across = pieces.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("start", "line")
    nth = F.sum((F.col("kind") == OPEN).cast("int")).over(order)
    joined = (
        across.withColumn("nth", nth)
        .groupBy("file", "nth")
        .agg(F.array_sort(F.collect_list(F.struct("start", "line", "text"))).alias("parts"))
        .select("file", F.expr("parts[0].start AS start"), F.expr("parts[0].line AS line"), F.expr("array_join(parts.text, '\n') AS text"))
    )
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "start", "line", "text").union(joined)
    first = (F.col("start") == 0) & (F.col("line") == 0)
    text = F.when(first, F.ltrim("text", F.lit("﻿"))).otherwise(F.col("text"))
    rows = whole.select("file", first.alias("first"), F.rtrim(text, F.lit("\r")).alias("text"))
    return rows.where(F.trim("text") != "")
