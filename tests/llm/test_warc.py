import base64
import hashlib
import struct

import pytest
import zstandard

from devpulse.llm.registry import op8
from devpulse.llm.warc import DICTIONARY_MAGIC, archive, parse, read_archives, record, records, write_archives

PAGES = [(1, "a"), (5, "a"), (3, "a"), (2, None), (7, ""), (9, "é" * 3000), (None, "b"), (4, "b"), (8, "<p>\r\n\r\n</p>"), (9, "é" * 3000)]


@pytest.fixture
def pages(spark):
    rows = [(i, f"http://x/{i}\r\nX: y", h, "z") for i, h in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, kept string")


def sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.mark.parametrize("size", [1, 1 << 20])
def test_round_trip(spark, pages, tmp_path, size):
    write_archives(pages, str(tmp_path / "out"), archive_bytes=size)
    rows = read_archives(spark, str(tmp_path / "out")).collect()
    assert all(r.error is None for r in rows)
    largest = {}
    for i, h in PAGES:
        largest[h or ""] = max(largest.get(h or "", -1), i if i is not None else -1)
    want = []
    for i, h in PAGES:
        data, kept = (h or "").encode(), largest[h or ""]
        first = i == kept
        want.append((i, len(data), sha1(data), *(("response", None, data) if first else ("revisit", kept, None))))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload)) for r in rows]
    fix = lambda t: str((*t[:5], t[5] or None))
    assert sorted(map(fix, got)) == sorted(map(fix, want))


def made():
    some = [record(i, "http://x", 3, sha1(b"abc"), None, b"abc") for i in range(3)]
    return some, archive(some, b"WARC/1.1 dictionary content " * 20)


def test_frames_and_dictionary():
    some, data = made()
    assert struct.unpack("<I", data[:4])[0] == DICTIONARY_MAGIC
    assert [r for r, _ in records(data)] == some
    own = data[8 : 8 + struct.unpack("<I", data[4:8])[0]]
    packed = zstandard.compress(own)
    again = struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed + data[8 + len(own) :]
    assert [r for r, _ in records(again)] == some


def test_faults_are_told():
    some, data = made()
    assert [e for _, e in records(data[:-3])][-1].startswith("frame")
    broken = bytearray(data)
    broken[-6] ^= 255
    assert any(e for _, e in records(bytes(broken)))
    assert [e for _, e in records(b"no archive")][0].startswith("frame")
    for old, new in ((b"WARC/1.1", b"WARC/9"), (b"abc\r\n\r\n", b"abd\r\n\r\n"), (b"Content-Length: 3", b"Content-Length: 4"), (b"response\r\n", b"other\r\n"), (b"abc\r\n", b"abcd\r\n"), (b"WARC-Date", b"Date")):
        with pytest.raises(ValueError):
            parse(some[0].replace(old, new, 1))


def test_empty_table(spark, pages, tmp_path):
    write_archives(pages.limit(0), str(tmp_path / "out"))
    assert read_archives(spark, str(tmp_path / "out")).count() == 0


def test_query(spark):
    import __spark_entry__ as contract
    from compare import connect, difference

    folder = contract.SMOKE_FOLDER
    assert difference(op8(spark, folder), connect(folder), contract.oracle_sql()["op8_warc"]) is None
