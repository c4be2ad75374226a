"""The corpus pipeline: from `documents` to packed training sequences.

Each stage takes (spark, docs, sf_dir) and gives a frame that is written and read again as the
next one's `docs`; all but the last keep the columns of `documents`.  Rows go only where a stage's
decision says so; secrets are replaced in the text instead."""

from pyspark.sql import DataFrame, SparkSession

from devpulse.llm.common import stored, table
from devpulse.llm.decontaminate import without_leaks
from devpulse.llm.packing import pack
from devpulse.llm.secrets import redact
from devpulse.llm.simhash import keep_one
from devpulse.llm.toxicity import without_toxic


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts toxic go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: fingerprints of three-word shingles that
    links of at most three differing bits connect."""
    return keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a stretch that aligns with a test item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; every document stays."""
    return redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths, none across documents."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# no stage but the last two is a query that SQL could state
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's frame; what each stage before it gives is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
