"""Web archives whose records are single Zstandard frames that share a dictionary.

An archive starts with a skippable frame holding the dictionary; one frame per record follows.
Pages of equal content are written once, as `response`; the others are `revisit` records that
refer to it.  Archives of bounded size are made in the tasks and written by Spark's own text
writer, whose line separator is an empty skippable frame, so any file system Spark reaches will
do and a lost task leaves nothing behind.

Null html counts as empty; a null page_id stays null and counts as the smallest; pages repeating
the largest page_id of a content are all `response`.  An empty table gives no archive and no rows.
A record that breaks the format comes back with its fault in `error` and null elsewhere."""

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devpulse.llm.common import batch, pieces, stored, utf8

# fixed values of the formats
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
# an empty skippable frame, written after each archive
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 64 << 10
# pages whose first bytes an archive's dictionary is made from
SAMPLED = 200
SAMPLE_BYTES = 4096
LEVEL = 3
ID = re.compile(rb"<urn:page:(-?\d+|null)>")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload_bytes: int, sha1: str, response, payload: bytes) -> bytes:
    """One WARC record.  `response`: None for a response, else the page_id it refers to in a list."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % payload_bytes
    name = lambda i: "null" if i is None else str(i)
    target = re.sub(r"[\r\n]+", " ", url or "")
    kind = "response" if response is None else "revisit"
    block = http + (payload if response is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name(page_id)}>",
        f"WARC-Target-URI: {target}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{sha1}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if response is not None:
        lines += [
            f"WARC-Refers-To: <urn:page:{name(response[0])}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary for the archive: the beginnings of some of its pages, the last counting most."""
    content = b"".join(p[:SAMPLE_BYTES] for p in payloads[:SAMPLED])
    return content[-DICTIONARY_BYTES:]


def archive(records: list[bytes], shared: bytes) -> bytes:
    """The dictionary in a skippable frame, then a frame per record."""
    held = zstandard.ZstdCompressionDict(shared, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True)
    frames = [struct.pack("<II", DICTIONARY_MAGIC, len(shared)) + shared]
    return b"".join(frames + [packer.compress(r) for r in records])


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that starts at `at` ends, by its block headers."""
    head = bytes(data[at : at + 18])
    checked = zstandard.get_frame_parameters(head).has_checksum
    at += zstandard.frame_header_size(head)
    last = False
    while not last:
        if at + 3 > len(data):
            raise ValueError("truncated frame")
        header = int.from_bytes(data[at : at + 3], "little")
        last, kind, length = bool(header & 1), header >> 1 & 3, header >> 3
        at += 3 + (1 if kind == 1 else length)
    at += 4 * checked
    if at > len(data):
        raise ValueError("truncated frame")
    return at


def records(data: bytes) -> Iterator[tuple[bytes | None, str | None]]:
    """The records of an archive, each as (bytes, None) or (None, fault); a fault that hides where
    the next frame starts ends the archive."""
    view, at, unpacker = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        try:
            if len(view) - at < 8:
                raise ValueError("truncated frame")
            magic, length = struct.unpack("<II", view[at : at + 8])
            if magic >> 4 == 0x184D2A5:
                if at + 8 + length > len(view):
                    raise ValueError("truncated skippable frame")
                if magic == DICTIONARY_MAGIC and at == 0:
                    shared = bytes(view[8 : 8 + length])
                    if shared[:4] == FRAME_MAGIC:
                        shared = zstandard.ZstdDecompressor().decompress(shared)
                    unpacker = zstandard.ZstdDecompressor(
                        dict_data=zstandard.ZstdCompressionDict(shared)
                    )
                at += 8 + length
                continue
            end = frame_end(view, at)
        except (ValueError, zstandard.ZstdError) as e:
            yield None, f"frame: {e}"
            return
        try:
            yield unpacker.decompress(view[at:end]), None
        except zstandard.ZstdError as e:
            yield None, f"frame: {e}"
        at = end


def parse(data: bytes) -> dict:
    """A record's fields; raises ValueError at the first header or length that is wrong."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise ValueError("no WARC version line")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line without a colon")
        fields[name.strip().lower()] = value.strip()
    for name in (b"warc-type", b"warc-record-id", b"warc-date", b"content-length"):
        if name not in fields:
            raise ValueError(f"no {name.decode()}")
    if not re.fullmatch(rb"\d+", fields[b"content-length"]):
        raise ValueError("content-length is no number")
    length = int(fields[b"content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("content-length differs from the block")
    http, found, payload = rest[:length].partition(b"\r\n\r\n")
    stated = re.search(rb"\r\nContent-Length: (\d+)(?:\r\n|$)", http)
    if not found or not http.startswith(b"HTTP/1.") or not stated:
        raise ValueError("no HTTP header in the block")
    sha1 = fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode()
    kind = fields[b"warc-type"].decode()
    own = ID.fullmatch(fields[b"warc-record-id"])
    if kind not in ("response", "revisit") or not own:
        raise ValueError("record type or id of another kind")
    refers = None
    if kind == "revisit":
        refers = ID.fullmatch(fields.get(b"warc-refers-to", b""))
        if payload or not refers:
            raise ValueError("revisit with a payload or without what it refers to")
    elif len(payload) != int(stated[1]) or digest(payload) != sha1:
        raise ValueError("payload differs from its length or digest")
    number = lambda m: None if m is None or m[1] == b"null" else int(m[1])
    return {
        "page_id": number(own),
        "url": fields.get(b"warc-target-uri", b"").decode(),
        "payload_bytes": int(stated[1]),
        "payload_digest": sha1,
        "record_type": kind,
        "refers_to": number(refers),
        "payload": payload if kind == "response" else None,
        "error": None,
    }


def digests(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes and payload_digest of every page."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    )

    def run(batches):
        for b in pieces(batches):
            html = utf8(b["html"])
            columns = {
                "page_id": b["page_id"],
                "payload_bytes": [len(x) for x in html],
                "payload_digest": [digest(x) for x in html],
            }
            yield batch(schema, columns)

    return pages.select(F.col("page_id").cast("long"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string"
    )


def revisits(pages: DataFrame) -> DataFrame:
    """Contents that occur more than once: payload_digest, and the page_id that keeps them."""
    return (
        digests(pages)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("kept"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("payload_digest", "kept")
    )


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write `pages` (page_id, url, html) as archives below `path`.

    Only digests are shuffled to find equal contents.  Pages meet the contents that repeat by a
    join on the digest, in which adaptive execution splits hot contents."""
    repeated = stored(revisits(pages))
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()), ("sha1", pa.string())]
    schema = pa.schema(fields)

    def sign(batches):
        for b in pieces(batches):
            columns = {n: b[n] for n in ("page_id", "url", "html")}
            yield batch(schema, columns | {"sha1": [digest(x) for x in utf8(b["html"])]})

    def build(batches):
        made = pa.schema([("archive", pa.binary())])
        rows: list[bytes] = []
        sample: list[bytes] = []
        size = 0
        for b in pieces(batches, 64):
            html = utf8(b["html"])
            for page, url, sha1, kept, again, data in zip(
                *(b[n].to_pylist() for n in ("page_id", "url", "sha1", "kept", "again")), html, strict=True
            ):
                response = None if not again or kept == page else [kept]
                rows.append(record(page, url, len(data), sha1, response, data))
                size += len(rows[-1])
                if response is None and len(sample) < SAMPLED:
                    sample.append(data[:SAMPLE_BYTES])
                if size >= archive_bytes:
                    yield batch(made, {"archive": [archive(rows, dictionary(sample))]})
                    rows, sample, size = [], [], 0
        if rows:
            yield batch(made, {"archive": [archive(rows, dictionary(sample))]})

    signed = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    ).mapInArrow(sign, "page_id long, url string, html string, sha1 string")
    joined = signed.join(
        repeated.withColumn("again", F.lit(True)), F.col("sha1") == F.col("payload_digest"), "left"
    ).select("page_id", "url", "html", "sha1", "kept", "again")
    (
        joined.mapInArrow(build, "archive binary")
        .select(F.col("archive").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR)
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below `path`: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, payload (of responses), error."""
    fields = [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("error", pa.string()),
    ] + ([("payload", pa.binary())] if with_payload else [])
    schema = pa.schema(fields)

    def run(batches):
        rows: list[dict] = []
        for b in pieces(batches, 1):
            for data, fault in records(b["content"][0].as_buffer()):
                if fault is None:
                    try:
                        rows.append(parse(data))
                    except ValueError as e:
                        fault = str(e)
                if fault is not None:
                    rows.append(dict.fromkeys(schema.names) | {"error": fault})
                if len(rows) >= 256:
                    yield batch(schema, {n: [r[n] for r in rows] for n in schema.names})
                    rows = []
        if rows:
            yield batch(schema, {n: [r[n] for r in rows] for n in schema.names})

    ddl = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, error string"
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select("content")
        .mapInArrow(run, ddl + (", payload binary" if with_payload else ""))
    )
