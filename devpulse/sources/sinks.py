"""Writing tables, and cutting lineage."""

import atexit
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def write_full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace everything at `path`."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


REPLACEMENT = "_replacement.json"


def write_replace_years(
    df: DataFrame, path: str, years: Sequence[int], year_column: str = "survey_year"
) -> None:
    """Replace the rows of `years`; the folders of other years are neither read nor written.

    A listed year without rows in `df` ends up empty.  Rows of a year that isn't listed, or of
    none, fail the write before anything is changed.  `df` is computed once, into a folder beside
    the years that readers skip; a note of what is to be put where then decides the replacement,
    and folders are renamed.  If it stops before the note, the old rows stand; if after, this
    function or `finish_replacement` carries it out first thing next time."""
    spark = df.sparkSession
    finish_replacement(spark, path)
    staged = f"{path}/_new-{uuid.uuid4().hex}"
    df.write.partitionBy(year_column).parquet(staged)
    given = {n for n in names_in(spark, staged) if "=" in n}
    listed = {f"{year_column}={y}" for y in years}
    if given - listed:
        delete_path(spark, staged)
        raise ValueError(f"rows of years other than {sorted(years)}")
    note = {"staged": staged, "given": sorted(given), "emptied": sorted(listed - given)}
    write_note(spark, f"{path}/{REPLACEMENT}", json.dumps(note))
    finish_replacement(spark, path)


def finish_replacement(spark: SparkSession, path: str) -> None:
    """Carry out a replacement that was decided; without one, nothing.  May be stopped and called
    again at any point."""
    note = f"{path}/{REPLACEMENT}"
    if not path_exists(spark, note):
        return
    todo = json.loads(read_note(spark, note))
    for folder in todo["emptied"]:
        delete_path(spark, f"{path}/{folder}")
    for folder in todo["given"]:
        # one that is no longer there has been moved
        if path_exists(spark, f"{todo['staged']}/{folder}"):
            delete_path(spark, f"{path}/{folder}")
            rename(spark, f"{todo['staged']}/{folder}", f"{path}/{folder}")
    delete_path(spark, todo["staged"])
    delete_path(spark, note)


def files_of(spark: SparkSession, path: str):
    """(file system, path) as the session's Hadoop settings have them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    files, at = files_of(spark, path)
    return files.exists(at)


def names_in(spark: SparkSession, path: str) -> list[str]:
    files, at = files_of(spark, path)
    return [f.getPath().getName() for f in files.listStatus(at)]


def rename(spark: SparkSession, old: str, new: str) -> None:
    files, at = files_of(spark, old)
    if not files.rename(at, files_of(spark, new)[1]):
        raise OSError(f"{old} could not be renamed to {new}")


def read_note(spark: SparkSession, path: str) -> str:
    """The line of a note.  Spark's readers skip files whose names begin like a note's."""
    files, at = files_of(spark, path)
    java = spark._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(files.open(at), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    part = f"{path}.part"
    files, at = files_of(spark, part)
    stream = files.create(at, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename(spark, part, path)


def append_results(df: DataFrame, path: str, run_id: str | None = None) -> str | None:
    """Add check results to the log.  Results without a `run_id` get the given one, or a new
    random one, the same for all rows; what they got is returned."""
    if "run_id" not in df.columns:
        run_id = run_id or str(uuid.uuid4())
        df = df.select(F.lit(run_id).alias("run_id"), "*")
    df.write.mode("append").parquet(path)
    return run_id


def materialize(
    df: DataFrame, name: str, kind: str = "view", bucket_by: Sequence[str] = (), buckets: int = 0
) -> DataFrame:
    """Publish a model under `name`, as a temporary view or as a table.

    Tables with equal `bucket_by` and `buckets` are joined on these columns without a shuffle;
    choose as many buckets as keep one within a task's memory."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite")
        if bucket_by:
            writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
        writer.saveAsTable(name)
    else:
        raise ValueError(f"unknown materialization {kind!r}")
    return df.sparkSession.table(name)


def scratch_table(df: DataFrame, bucket_by: Sequence[str], buckets: int) -> DataFrame:
    """A bucketed table that ends with the innermost scratch scope."""
    name = f"devpulse_{uuid.uuid4().hex}"
    _scopes[-1].append(f"table:{name}")
    return materialize(df, name, "table", bucket_by, buckets)


def scratch_path(spark: SparkSession) -> str | None:
    """A new path in the session's shared checkpoint folder, None where it has none.  It is
    listed in the innermost open scope, which deletes it at its end."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        return None
    path = f"{folder.rstrip('/')}/devpulse-{uuid.uuid4().hex}"
    _scopes[-1].append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark's file systems have it, or what a scope lists as a table;
    one that is gone is no error."""
    if path.startswith("table:"):
        spark.sql(f"DROP TABLE IF EXISTS {path.removeprefix('table:')}")
    else:
        files, at = files_of(spark, path)
        files.delete(at, True)


# paths and tables by open scope, innermost last; the first is the process's own
_scopes: list[list[str]] = [[]]


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What is written to scratch inside is deleted at the end, an error's included.

    Consume results inside, or write them out with `cut_lineage` after leaving an inner scope:
    `with scratch_scope(spark): said_vs_did(...).write.parquet(path)`."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete_path(spark, path)


def in_scope(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """`f` with a scratch scope of its own: what it returns is written once to the caller's scope,
    and its other files are deleted before the caller goes on."""

    @wraps(f)
    def run(*args, **kwargs) -> DataFrame:
        frames = [x for x in (*args, *kwargs.values()) if isinstance(x, DataFrame)]
        spark = frames[0].sparkSession
        _scopes.append([])
        own = _scopes[-1]
        try:
            out = f(*args, **kwargs)
            _scopes.pop()
            # without files nothing needs to be kept
            return cut_lineage(out) if own else out
        finally:
            if _scopes[-1] is own:
                _scopes.pop()
            for path in own:
                delete_path(spark, path)

    return run


def clear_scratch() -> None:
    """Delete what is listed in no scope but the process's own; called when Python ends."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        while _scopes[0]:
            delete_path(spark, _scopes[0].pop())


atexit.register(clear_scratch)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the session's shared checkpoint folder and read it back.

    Models built on the result start from files that outlive a lost executor, read only the
    columns they need, and know the table's real size, which lets Spark broadcast it when it
    is small.  The files live as long as the innermost `scratch_scope`, or the process.  A
    session without such a folder gets the frame back unchanged."""
    path = scratch_path(df.sparkSession)
    if path is None:
        return df
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
