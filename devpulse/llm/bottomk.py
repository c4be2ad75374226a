"""Bottom-k sketches: of a text's shingle hashes the k smallest distinct ones.

Shingles are windows of `WIDTH` code points over the text with WIDTH - 1 marks before it, so a
text of n code points has n of them and a short text still has several.  A sketch with fewer than
k values holds all of its set.  Sketches of parts merge into the sketch of the union; from two of
them follow resemblance and containment, from one the number of distinct shingles.

Null texts count as empty; the sketch of an empty text is empty, resembles another empty one fully
and any other not at all."""

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devpulse.llm.common import batch, pieces, text_column, utf8

K = 128
WIDTH = 12
HASH_BITS = 48
# what stands before a text: no code point
MARK = 0x110000
MULTIPLIER = 0x9E3779B97F4A7C15


def shingle_hashes(text: str, width: int = WIDTH) -> np.ndarray:
    """A hash of HASH_BITS bits for the window that ends at each code point."""
    codes = np.full(len(text) + width - 1, MARK, np.uint64)
    codes[width - 1 :] = np.frombuffer(text.encode("utf-32-le"), "<u4")
    # polynomial hashes of windows of doubling width, put together for the bits of `width`
    h, span, got, got_span = codes, 1, None, 0
    rest = width
    while True:
        if rest & 1:
            if got is None:
                got, got_span = h, span
            else:
                power = np.uint64(pow(MULTIPLIER, got_span, 1 << 64))
                n = len(codes) - span - got_span + 1
                got, got_span = h[:n] * power + got[span : span + n], got_span + span
        rest >>= 1
        if not rest:
            break
        power = np.uint64(pow(MULTIPLIER, span, 1 << 64))
        h, span = h[:-span] * power + h[span:], 2 * span
    got = got ^ (got >> np.uint64(31))
    got = got * np.uint64(0xBF58476D1CE4E5B9)
    got = (got ^ (got >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return got >> np.uint64(64 - HASH_BITS)


def smallest(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct values, in order."""
    m = 4 * k
    while m < len(hashes):
        found = np.unique(np.partition(hashes, m)[:m])
        if len(found) > k:
            return found[:k]
        m *= 4
    return np.unique(hashes)[:k]


def sketch(text: str, k: int = K) -> np.ndarray:
    return smallest(shingle_hashes(text), k)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of the union's shingles that both have."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    both = np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True)
    return len(both) / len(union)


def distinct(a: np.ndarray, k: int = K) -> float:
    """Number of distinct shingles: exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**HASH_BITS / (float(a[k - 1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of a's shingles that b has."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def to_text(a: np.ndarray) -> str:
    """Six bytes a value, big-endian, in base 64."""
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    six = np.frombuffer(base64.b64decode(s), np.uint8).reshape(-1, 6)
    return np.hstack([np.zeros((len(six), 2), np.uint8), six]).copy().view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Per document: doc_id, n_chars, fingerprint, n_shingles (distinct, estimated)."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string()), ("n_shingles", pa.float64())]
    )

    def run(batches):
        for b in pieces(batches):
            texts = b["text"].to_pylist()
            made = [sketch(t, k) for t in texts]
            columns = {
                "doc_id": b["doc_id"],
                "n_chars": [len(t) for t in texts],
                "fingerprint": [to_text(a) for a in made],
                "n_shingles": [distinct(a, k) for a in made],
            }
            yield batch(schema, columns)

    return docs.select(F.col("doc_id").cast("long"), text_column().alias("text")).mapInArrow(
        run, "doc_id long, n_chars long, fingerprint string, n_shingles double"
    )


def merged(sketches: DataFrame, by: str, k: int = K, salts: int = 64) -> DataFrame:
    """Sketches of the unions by the column `by`: (by, fingerprint).

    Sketches of a key meet in `salts` parts first and those parts then, so no task gathers a hot
    key; what a task holds is one sketch."""

    whole = isinstance(sketches.schema[by].dataType, T.LongType | T.IntegerType)
    schema = pa.schema([("key", pa.int64() if whole else pa.string()), ("fingerprint", pa.string())])

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.array([], np.uint64)
        for b in batches:
            for s in b["fingerprint"].to_pylist():
                total = merge(total, from_text(s or ""), k)
        yield batch(schema, {"key": [key[0].as_py()], "fingerprint": [to_text(total)]})

    ddl = f"key {'long' if whole else 'string'}, fingerprint string"
    part = F.pmod(F.xxhash64("fingerprint"), F.lit(salts)).alias("part")
    keyed = sketches.select(F.col(f"`{by}`").cast("long" if whole else "string").alias("key"), "fingerprint")
    first = keyed.groupBy("key", part).applyInArrow(run, ddl)
    return first.groupBy("key").applyInArrow(run, ddl).withColumnRenamed("key", by)


def in_order(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, edge, place, tie, doc_id, body): documents dealt to ranges of doc_id, and at the
    end of each range (edge = 1) the document that the next range begins with, largest ids first
    and the largest after the smallest.  `body` is the text under Zstandard.

    The driver sees range bounds and the largest id of each range: as many numbers as ranges."""
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("place"))
    shares = [i / buckets for i in range(1, buckets)]
    bounds = np.array(sorted(set(ids.approxQuantile("place", shares, 0.25 / buckets))), np.float64)
    largest = (
        ids.mapInArrow(
            lambda it: (
                pa.RecordBatch.from_arrays(
                    [pa.array(np.searchsorted(bounds, b["place"].to_numpy().astype(np.float64)), pa.int32()), b["place"]],
                    ["bucket", "place"],
                )
                for b in it
            ),
            "bucket int, place long",
        )
        .groupBy("bucket")
        .agg(F.max("place").alias("place"))
        .orderBy(F.desc("bucket"))
        .collect()
    )
    # the range that a range's first document also closes
    closes = {r["place"]: largest[i - 1]["bucket"] for i, r in enumerate(largest)}
    schema = pa.schema(
        [("bucket", pa.int32()), ("edge", pa.int32()), ("place", pa.int64()), ("tie", pa.binary()), ("doc_id", pa.int64()), ("body", pa.binary())]
    )

    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for b in pieces(batches):
            rows: dict[str, list] = {n: [] for n in schema.names}
            places = b["place"].to_pylist()
            owns = np.searchsorted(bounds, b["place"].to_numpy().astype(np.float64)).tolist()
            for place, own, doc, data in zip(places, owns, b["doc_id"].to_pylist(), utf8(b["text"]), strict=True):
                row = (place, hashlib.sha256(data).digest()[:8], doc, packer.compress(data))
                for bucket, edge in [(own, 0)] + ([(closes[place], 1)] if place in closes else []):
                    for n, v in zip(schema.names, (bucket, edge, *row), strict=True):
                        rows[n].append(v)
            yield batch(schema, rows)

    wanted = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("place"),
        F.col("doc_id").cast("long"),
        text_column().alias("text"),
    )
    return wanted.mapInArrow(run, "bucket int, edge int, place long, tie binary, doc_id long, body binary")


def compare_edited(docs: DataFrame, k: int = K) -> DataFrame:
    """Each document against its edited text and against the next document, by falling doc_id.

    Edited: the last third of the code points, rounded down, replaced by the first as many (or all)
    of the next document; the first follows the last.  Null ids come last, rows of equal ids by
    the SHA-256 of their texts.  Texts are shuffled once, compressed; a task streams its ranges in
    order and holds two documents."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string())]
    fields += [("fingerprint", pa.string()), ("edited_fingerprint", pa.string())]
    fields += [("near_edited", pa.float64()), ("near_next", pa.float64())]
    schema = pa.schema([*fields, ("n_shingles", pa.float64())])

    def run(batches):
        unpacker = zstandard.ZstdDecompressor()
        before, bucket = None, None
        for b in pieces(batches, 256):
            rows: dict[str, list] = {n: [] for n in schema.names}
            for own, edge, doc, body in zip(*(b[n].to_pylist() for n in ("bucket", "edge", "doc_id", "body")), strict=True):
                if own == bucket and before is None:
                    continue  # the range is closed
                bucket = own
                text = unpacker.decompress(body).decode()
                made = sketch(text, k)
                if before is not None:
                    old_doc, old, old_made = before
                    third = len(old) // 3
                    edited = old[: len(old) - third] + text[:third]
                    edited_made = sketch(edited, k)
                    sha = hashlib.sha256(edited.encode()).hexdigest()
                    row = (old_doc, len(old), sha, to_text(old_made), to_text(edited_made))
                    row += (resemblance(old_made, edited_made, k), resemblance(old_made, made, k), distinct(old_made, k))
                    for n, v in zip(schema.names, row, strict=True):
                        rows[n].append(v)
                before = None if edge else (doc, text, made)
            yield batch(schema, rows)

    ddl = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_shingles double"
    return (
        in_order(docs, buckets)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "edge", F.desc("place"), "tie")
        .drop("place", "tie")
        .mapInArrow(run, ddl)
    )
