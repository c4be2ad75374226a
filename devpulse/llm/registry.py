"""The corpus operators as queries over the given tables; SQL where SQL can say the same."""

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devpulse.llm import minhash, quality, toxicity
from devpulse.llm.alignment import aligned_documents
from devpulse.llm.bottomk import compare_edited
from devpulse.llm.common import table
from devpulse.llm.decontaminate import contaminated
from devpulse.llm.hmm import learn_and_score
from devpulse.llm.packing import pack
from devpulse.llm.secrets import find_secrets
from devpulse.llm.simhash import near_duplicates
from devpulse.llm.surrogates import replace_entities
from devpulse.llm.vgram import spelling_variants
from devpulse.llm.warc import read_archives, write_archives
from devpulse.sources.sinks import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def shared_path(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    path = scratch_path(spark)
    if path is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return path


def checked(records: DataFrame) -> DataFrame:
    """The records; a broken one fails the job instead of passing as a row of nulls."""
    fails = F.raise_error(F.col("error")).cast("boolean")
    return records.where(F.when(F.col("error").isNull(), True).otherwise(fails))


@query("op10_packing")
def op10(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    return pack(
        table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False
    ).drop("bucket")


@query(
    "op8_warc",
    """with hashed as (
         select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
       ), coded as (
         select page_id, hex, strlen(html) as payload_bytes,
                list_aggregate(list_transform(range(32), lambda k: substr(
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + cast((cast('0x' || substr(hex, 1 + 10 * cast(k // 8 as integer), 10) as bigint)
                      >> (35 - 5 * (k % 8))) & 31 as integer), 1)), 'string_agg', '') as payload_digest
         from hashed
       ), kept as (select hex, max(page_id) as top from coded group by hex)
       select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
              case when page_id is not distinct from top then 'response' else 'revisit' end as record_type,
              case when page_id is not distinct from top then null else top end as refers_to
       from coded join kept using (hex)""",
)
def op8(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark)
    write_archives(table(spark, d, "pages"), path)
    return checked(read_archives(spark, path, with_payload=False)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op1_secret_scans")
def op1(spark: SparkSession, d: str) -> DataFrame:
    return find_secrets(table(spark, d, "documents")).drop("redacted")


@query("op9_fingerprints")
def op9(spark: SparkSession, d: str) -> DataFrame:
    return compare_edited(table(spark, d, "documents"))


@query("op3_simhash")
def op3(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(table(spark, d, "documents"))


@query("op5_language_model")
def op5(spark: SparkSession, d: str) -> DataFrame:
    return learn_and_score(table(spark, d, "documents"))


@query("op6_decontamination")
def op6(spark: SparkSession, d: str) -> DataFrame:
    return contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op2_toxicity")
def op2(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.scored(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op7_quality_classifier")
def op7(spark: SparkSession, d: str) -> DataFrame:
    return quality.scored(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op4_surrogates")
def op4(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    # without a key of the session's, one that nobody has
    key = spark.conf.get("spark.devpulse.surrogates.key", None) or secrets.token_hex(32)
    return replace_entities(docs, key).select("doc_id", "text", "n_entities", F.array_join("kinds", ",").alias("kinds"))


@query("op11_tokenizer_alignment")
def op11(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    names = ("byte_bpe_50k.json", "piece_bpe_32k.model")
    return aligned_documents(table(spark, d, "documents"), *map(public_tokenizers.path, names))


@query("op12_minhash")
def op12(spark: SparkSession, d: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, d, "documents"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, d: str) -> DataFrame:
    return spelling_variants(table(spark, d, "documents"))
