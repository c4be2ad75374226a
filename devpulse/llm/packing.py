"""Packing by binary decomposition: a document of n tokens becomes pieces of the lengths of the
binary digits of n, the longest `capacity`, and each piece is a sequence of its own.

Sequences of one length form a bucket, so batches need no padding, and no sequence holds tokens
of two documents.  Pieces come longest first: whole capacities, then the falling powers of two.

Nothing is shuffled and nothing is kept beyond one batch but a bounded cache of chunk ids.
Null texts give the end token alone, null ids stay null, repeated rows are packed each on their
own, an empty table gives no rows."""

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.llm.common import batch, pieces, text_column

CAPACITY = 4096
END_ID = 2
# chunks whose ids a worker remembers
CACHED = 500_000
# what str.split() takes for white space and the tokenizer does not
SEPARATORS = re.compile("[\x1c-\x1f]")
BLANKS = re.compile("[ \t\n\x0b\x0c\r]+")


def binary_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of `n` tokens, longest first; `capacity` is a power of two."""
    rest = n % capacity
    return [capacity] * (n // capacity) + [
        1 << b for b in range(capacity.bit_length() - 2, -1, -1) if rest >> b & 1
    ]


class Chunks:
    """Token ids of texts, by way of the ids of their chunks between white space.

    The tokenizer drops white space and no token spans it, so a text's ids are its chunks' ids in
    a row.  Chunks are given to the tokenizer once and then remembered, as little-endian bytes:
    at most two generations of `CACHED`, of which the older goes when the younger is full."""

    _loaded: dict[str, "Chunks"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.closes = np.array(
            [str(self.tokenizer.id_to_token(i)).endswith("</w>") for i in range(size)]
        )
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> "Chunks":
        """The worker's own, kept from task to task."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def each(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk, asked for one by one."""
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def together(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks of letters alone, asked for as one text: each is one word of it, whose
        last token is the only one to close a word."""
        (found,) = self.tokenizer.encode_batch_fast([" ".join(chunks)], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        ends = 4 * (np.flatnonzero(self.closes[ids]) + 1)
        if len(ends) != len(chunks):
            return self.each(chunks)
        data = ids.tobytes()
        ends = ends.tolist()
        return [data[s:e] for s, e in zip([0, *ends], ends, strict=False)]

    def learn(self, chunks: set[str]) -> None:
        if len(self.known) > CACHED:
            self.older, self.known = self.known, {}
        letters, others, marked = set(), [], []
        for c in chunks - self.known.keys():
            ids = self.older.get(c)
            if ids is not None:
                self.known[c] = ids
            elif c.isalpha():
                letters.add(c)
            elif c[-1] in ",." and c[:-1].isalpha():
                # a word and a mark are two words to the tokenizer
                marked.append(c)
                letters.add(c[:-1])
            else:
                others.append(c)
        if marked:
            others += [m for m in ",." if m not in self.known]
        letters -= self.known.keys()
        for ask, wanted in ((self.together, list(letters)), (self.each, others)):
            for start in range(0, len(wanted), 20_000):
                part = wanted[start : start + 20_000]
                self.known.update(zip(part, ask(part), strict=True))
        for c in marked:
            self.known[c] = self.known[c[:-1]] + self.known[c[-1]]

    def ids(self, texts: list[str], end_id: int) -> list[np.ndarray]:
        """The ids of each text and `end_id`."""
        split = [
            [c for c in BLANKS.split(t) if c] if SEPARATORS.search(t) else t.split() for t in texts
        ]
        self.learn(set(chain.from_iterable(split)))
        of, end = self.known.__getitem__, np.array([end_id], "<u4").tobytes()
        return [np.frombuffer(b"".join(map(of, s)) + end, "<u4") for s in split]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (if wanted), ids_crc32, doc_tokens, bucket
    (base-2 logarithm of the length), sequence_id, offset (always 0).

    `sequence_id` numbers the rows within the tasks of the one map stage that makes them."""
    fields = [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("bucket", pa.int32()),
    ] + ([("ids", pa.list_(pa.int32()))] if with_ids else [])
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        chunks = Chunks.of(tokenizer_path)
        for b in pieces(batches):
            rows: dict[str, list] = {f.name: [] for f in schema}
            texts = chunks.ids(b["text"].to_pylist(), end_id)
            for doc, data in zip(b["doc_id"].to_pylist(), texts, strict=True):
                at = 0
                for n in binary_lengths(len(data), capacity):
                    piece = data[at : at + n]
                    rows["doc_id"].append(doc)
                    rows["start"].append(at)
                    rows["length"].append(n)
                    rows["ids_crc32"].append(zlib.crc32(piece.tobytes()))
                    rows["doc_tokens"].append(len(data))
                    rows["bucket"].append(n.bit_length() - 1)
                    if with_ids:
                        rows["ids"].append(piece.astype(np.int32))
                    at += n
            yield batch(schema, rows)

    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int"
    return (
        docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
        .mapInArrow(run, ddl + (", ids array<int>" if with_ids else ""))
        .withColumns(
            {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
        )
    )
