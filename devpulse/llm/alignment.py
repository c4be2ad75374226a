"""Which tokens of two tokenizers go together.

A text's tokens of both lie on the same bytes.  Byte offsets where tokens of both end cut them into
groups, and every two tokens of a group are linked.  A pair of ids counts once for each document
that holds it linked.

The distinct pairs of the corpus get a minimal perfect hash, in buckets by the first id; counts are
dense vectors indexed by it, one a task and bucket, summed as a tree; each place keeps its pair, by
which lookups are verified.  A second pass aligns the documents again and looks their pairs up.

Neither tokenizer has a token across the end of a word before white space (checked when loaded), so
a text is aligned unit by unit: white space and the word after it.  A worker remembers the units it
has aligned."""

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.llm.common import batch, pieces, stored, text_column
from devpulse.llm.perfect import PerfectHash
from devpulse.sources.sinks import in_scope

# a pair's number is its first id times WIDTH and its second id; both vocabularies are smaller
WIDTH = 1 << 16
# pairs a bucket has on average, and most buckets
BUCKET = 1 << 16
BUCKETS = 1024
# vectors that are summed by one task at a time
FAN = 8
# pairs a task holds before they go out
HELD = 1_000_000
# a table of up to this many pairs (about 20 bytes each) is sent to all tasks; beyond, the pairs of
# the documents are joined with it
SENT_PAIRS = 4_000_000
# characters of units that a worker remembers; a batch that takes it beyond is the last with them
CACHED = 6_000_000
# characters aligned at once, unless a unit is longer, and links listed at once
BLOCK, LINKS = 200_000, 2_000_000
# white space as Unicode has it
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 for
    itself, all others in order from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(other)}}


# fixed: how byte-level vocabularies of this kind cut a text into words before they merge bytes
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_merger(tokenizer, spelled: dict[int, bytes]):
    """A function from a text to its ids, by the ranks of the vocabulary where ids are in the order
    of the merges (checked), which is several times as fast; else by the tokenizer itself."""
    import json

    import tiktoken

    model = json.loads(tokenizer.to_str())["model"]
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    first = model["vocab"].get(merged[0], 0) if merged else 0
    if not merged or any(model["vocab"].get(m) != first + i for i, m in enumerate(merged)):
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    ranks = {spelled[i]: i for i in model["vocab"].values() if i < first + len(merged)}
    return tiktoken.Encoding("bytes", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Vocabulary:
    """The bytes of each token, one after the other, and how many they are."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens in a row."""
        size = self.size[ids]
        ends = np.cumsum(size)
        first = np.repeat(self.start[ids] - (ends - size), size)
        return self.flat[first + np.arange(len(first))]


def decimal_digits(count: int) -> np.ndarray:
    """A row of five digits and a place for a separator for each number, zeros where none are."""
    table = np.zeros((count, 6), np.uint8)
    numbers = np.array([b"%d" % i for i in range(count)], "S5")
    table[:, :5] = numbers.view(np.uint8).reshape(count, 5)
    return table


class Units:
    """What is known of some units, a row each; `pair`, `times` (linked so often) lie between
    `pair_end` of the row before and of its own, `text` is its groups."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.size = 0
        self.text: list[bytes] = []
        self.number = np.zeros((6, 0), np.int64)  # valid, n_a, n_b, n_groups, n_links, pair_end
        self.pair, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, units: list[str], number: np.ndarray, text: list[bytes], pair, times) -> None:
        number[5] += len(self.pair)
        self.size += sum(map(len, units))
        self.rows.update(zip(units, range(len(self.text), len(self.text) + len(units)), strict=True))
        self.text += text
        self.number = np.concatenate([self.number, number], axis=1)
        self.pair, self.times = np.concatenate([self.pair, pair]), np.concatenate([self.times, times])


class Aligner:
    """Both tokenizers; kept by a worker from task to task."""

    _loaded: dict[tuple[str, str], "Aligner"] = {}

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        one = Tokenizer.from_file(path_a)
        one.encode_special_tokens = True
        self.two = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        spelled = [one.id_to_token(i) or "" for i in range(one.get_vocab_size())]
        # special tokens, which texts never get, may hold other letters
        self.a = Vocabulary([bytes(letters.get(c, 63) for c in s) for s in spelled])
        self.one = byte_merger(one, dict(enumerate(self.a.tokens)))
        pieces_b = [self.two.id_to_piece(i) for i in range(self.two.get_piece_size())]
        self.b = Vocabulary(
            [
                bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                for p in pieces_b
            ]
        )
        # white space that some piece has after a letter does not begin a unit
        glued = {m for p in pieces_b for m in re.findall(f"(?<=[^{BLANK}])[{BLANK}]", p.replace("▁", " "))}
        more = f"(?:[{re.escape(''.join(sorted(glued)))}][{BLANK}]*[^{BLANK}]*)*" if glued else ""
        self.unit = re.compile(f"[{BLANK}]*[^{BLANK}]+{more}|[{BLANK}]+")
        self.open = re.compile(f"[{BLANK}]\\Z")
        # a letter before a text keeps the second tokenizer from adding a space to it
        self.lead = self.two.encode("a")
        self.digits = decimal_digits(max(len(self.a.tokens), len(self.b.tokens)))
        self.known = Units()

    @classmethod
    def of(cls, path_a: str, path_b: str) -> "Aligner":
        if (path_a, path_b) not in cls._loaded:
            cls._loaded[path_a, path_b] = cls(path_a, path_b)
        return cls._loaded[path_a, path_b]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of either tokenizer, the text's bytes); the text begins with white space."""
        ids = np.array(self.one(text), np.int64)
        other = self.two.encode("a" + text)
        n = len(self.lead)
        other = other[n:] if other[:n] == self.lead else [0]
        return ids, np.array(other, np.int64), np.frombuffer(text.encode(), np.uint8)

    def learn(self, units: list[str], into: Units) -> None:
        block: list[str] = []
        size = 0
        for u in units:
            if self.open.search(u):
                # at the end of a text; another unit behind it would change it
                self.align([u], into)
                continue
            if block and size + len(u) > BLOCK:
                self.align(block, into)
                block, size = [], 0
            block.append(u)
            size += len(u)
        if block:
            self.align(block, into)

    def align(self, block: list[str], into: Units) -> None:
        """Align units in a row as one text; one by one if the bytes of some differ from it."""
        ids_a, ids_b, data = self.encode("".join(block))
        fits = all(
            v.size[ids].sum() == len(data) and np.array_equal(v.spell(ids), data)
            for v, ids in ((self.a, ids_a), (self.b, ids_b))
        )
        if not fits:
            if len(block) > 1:
                half = len(block) // 2
                self.align(block[:half], into)
                self.align(block[half:], into)
            else:
                into.add(block, np.zeros((6, 1), np.int64), [b""], into.pair[:0], into.times[:0])
            return
        sizes = [len(u) if u.isascii() else len(u.encode()) for u in block]
        into.add(block, *self.groups(ids_a, ids_b, np.cumsum(np.array(sizes, np.int64))))

    def groups(self, ids_a: np.ndarray, ids_b: np.ndarray, unit_end: np.ndarray):
        """What `Units.add` takes, of tokens that spell the same bytes."""
        ends_a, ends_b = np.cumsum(self.a.size[ids_a]), np.cumsum(self.b.size[ids_b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if not np.isin(unit_end, common).all():
            raise ValueError("a token lies across the end of a word")
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        in_a, in_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        unit_of = np.searchsorted(unit_end, common)  # of each group
        count = len(unit_end)

        def summed(x: np.ndarray) -> np.ndarray:
            return np.bincount(unit_of, x, count).astype(np.int64)

        # all tokens in the order in which the groups are written
        n_a, n_b = len(ids_a), len(ids_b)
        after_a, after_b = np.cumsum(in_a), np.cumsum(in_b)
        place_a = np.arange(n_a) + (after_b - in_b)[group_a]
        place_b = np.arange(n_b) + after_a[group_b]
        rows = np.zeros((n_a + n_b, 6), np.uint8)
        rows[place_a], rows[place_b] = self.digits[ids_a], self.digits[ids_b]
        for place, group, end in ((place_a, group_a, b"|"), (place_b, group_b, b";")):
            last = np.append(group[1:] != group[:-1], True)
            rows[place, 5] = np.where(last, end[0], b","[0])
        lengths = (rows != 0).sum(axis=1)
        text = rows[rows != 0].tobytes()
        tokens = np.cumsum(summed(in_a + in_b))
        cuts = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], tokens])].tolist()
        texts = [text[s : e - 1] for s, e in zip(cuts, cuts[1:], strict=False)]

        pair, times, unit = self.links(ids_a, ids_b, group_a, in_b, after_b - in_b, unit_of)
        number = np.stack(
            [
                np.ones(count, np.int64),
                summed(in_a),
                summed(in_b),
                np.bincount(unit_of, minlength=count),
                summed(in_a * in_b),
                np.cumsum(np.bincount(unit, minlength=count)),
            ]
        )
        return number, texts, pair, times

    def links(self, ids_a, ids_b, group_a, in_b, start_b, unit_of) -> tuple[np.ndarray, ...]:
        """(pair, times, unit) of the distinct links of each unit, by unit."""
        per_a = in_b[group_a]
        total = np.cumsum(per_a)
        found, start = [], 0
        while start < len(ids_a):
            done = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, done + LINKS, "right")))
            n = per_a[start:stop]
            who = np.repeat(np.arange(start, stop), n)
            nth = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            pair = ids_a[who] * WIDTH + ids_b[start_b[group_a[who]] + nth]
            found.append(unique_rows(unit_of[group_a[who]], pair, np.ones(len(pair), np.int64)))
            start = stop
        unit, pair, times = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(found) > 1:
            unit, pair, times = unique_rows(unit, pair, times)
        return pair, times, unit

    def rows_of(self, texts: list[str]) -> tuple[Units, list[np.ndarray | None]]:
        """The units of each text as rows of a table of units; None of a text without tokens."""
        split = [self.unit.findall(" " + t) if t else None for t in texts]
        if self.known.size > CACHED:
            self.known = Units()
        table, unknown = self.known, repeat(-1)
        look_up = table.rows.get

        def numbers(s: list[str] | None) -> np.ndarray | None:
            return None if s is None else np.fromiter(map(look_up, s, unknown), np.int64, len(s))

        rows = [numbers(s) for s in split]
        lacking = [np.flatnonzero(r < 0) if r is not None else () for r in rows]
        new = {s[i] for s, found in zip(split, lacking, strict=True) if len(found) for i in found.tolist()}
        self.learn(sorted(new), table)
        for s, r, found in zip(split, rows, lacking, strict=True):
            if len(found):
                r[found] = numbers([s[i] for i in found.tolist()])
        return table, [r if r is not None and table.number[0, r].all() else None for r in rows]


def unique_rows(one: np.ndarray, two: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct pairs of two columns, in order, and the sum of their weights."""
    order = np.lexsort((two, one))
    one, two, weight = one[order], two[order], weight[order]
    first = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))[: len(one)])
    return one[first], two[first], np.add.reduceat(weight, first) if len(first) else weight


def pairs_of(table: Units, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit, index) of all pairs of the units in `rows`, as places of `pair`."""
    end = table.number[5]
    start = np.append(0, end)[rows]
    n = end[rows] - start
    which = np.repeat(np.arange(len(rows)), n)
    return which, np.repeat(start - (np.cumsum(n) - n), n) + np.arange(len(which))


def pair_counts(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """(pair, n): how many documents of a part of the input hold a pair linked, several a pair."""
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def run(batches):
        aligner = Aligner.of(*paths)
        held, size = [], 0

        def out():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return batch(schema, {"pair": pa.array(pair), "n": pa.array(n)})

        for b in pieces(batches, 256):
            table, found = aligner.rows_of([t or "" for t in b["text"].to_pylist()])
            for rows in found:
                if rows is not None:
                    held.append(np.unique(table.pair[pairs_of(table, np.unique(rows))[1]]))
                    size += len(held[-1])
            if size > HELD:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return docs.select(text_column().alias("text")).mapInArrow(run, "pair long, n long")


def bucket(buckets: int):
    """The bucket of a pair: all pairs of a first id have the same, at most WIDTH pairs an id."""
    return F.pmod(F.shiftright("pair", 16), F.lit(buckets)).cast("int")


def hashes(counts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, hash, pairs): a perfect hash of each bucket's distinct pairs, and these in its order."""
    schema = pa.schema([("bucket", pa.int32()), ("hash", pa.binary()), ("pairs", pa.binary())])

    def build(group: pa.Table) -> pa.Table:
        pair = np.sort(group["pair"].to_numpy())
        perfect = PerfectHash.build(pair)
        placed = np.empty_like(pair)
        placed[perfect(pair)] = pair
        row = {"bucket": group["bucket"][:1].to_pylist(), "hash": [perfect.to_bytes()], "pairs": [placed.tobytes()]}
        return pa.table(row, schema=schema)

    distinct = counts.select("pair").distinct().withColumn("bucket", bucket(buckets))
    return distinct.groupBy("bucket").applyInArrow(build, "bucket int, hash binary, pairs binary")


def added(vectors: DataFrame) -> DataFrame:
    """(bucket, part, counts) with FAN parts of a bucket summed to one."""
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])

    def add(group: pa.Table) -> pa.Table:
        total = None
        for data in group["counts"]:
            own = np.frombuffer(data.as_py(), np.int64)
            total = own.copy() if total is None else total + own
        first = [group[c][:1].to_pylist() for c in ("bucket", "part")]
        return pa.table({"bucket": first[0], "part": first[1], "counts": [total.tobytes()]}, schema=schema)

    parts = vectors.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
    return parts.groupBy("bucket", "part").applyInArrow(add, "bucket int, part int, counts binary")


def count_vectors(counts: DataFrame, hashed: DataFrame, buckets: int) -> DataFrame:
    """(bucket, counts): the documents of each pair, in the order of the bucket's hash."""
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])
    # a bucket's hash goes to the rows of its pairs; a group is one bucket in one part of the rows
    spread = counts.select("pair", "n", bucket(buckets).alias("bucket"), F.spark_partition_id().alias("part"))

    def dense(left: pa.Table, right: pa.Table) -> pa.Table:
        perfect = PerfectHash.from_bytes(right["hash"][0].as_py())
        total = np.zeros(perfect.size, np.int64)
        np.add.at(total, perfect(left["pair"].to_numpy()), left["n"].to_numpy())
        row = {"bucket": left["bucket"][:1].to_pylist(), "part": left["part"][:1].to_pylist(), "counts": [total.tobytes()]}
        return pa.table(row, schema=schema)

    parts = spread.select(F.col("bucket").alias("of"), F.col("part").alias("at")).distinct()
    parts = parts.join(hashed.select(F.col("bucket").alias("of"), "hash"), "of")
    vectors = spread.groupBy("bucket", "part").cogroup(parts.groupBy("of", "at"))
    now = stored(vectors.applyInArrow(dense, "bucket int, part int, counts binary"))
    last = now.agg(F.max("part")).first()[0] or 0
    while last:
        now, last = stored(added(now)), last // FAN
    return now.select("bucket", "counts")


class Counts:
    """Counts of pairs by bucket, and whether a count is the highest of the pair's first id."""

    def __init__(self, rows):
        self.of = {}
        for at, data, pairs, counts in rows:
            pair, n = np.frombuffer(pairs, np.int64), np.frombuffer(counts, np.int64)
            self.of[at] = (PerfectHash.from_bytes(data), pair, n, is_best(pair, n))

    def look_up(self, pair: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        n, best = np.zeros(len(pair), np.int64), np.zeros(len(pair), bool)
        where = (pair >> 16) % buckets
        for at in np.unique(where).tolist():
            some = np.flatnonzero(where == at)
            perfect, known, count, top = self.of[at]
            place = perfect(pair[some])
            if (place < 0).any() or (known[place] != pair[some]).any():
                raise ValueError("a pair that the first pass did not see")
            n[some], best[some] = count[place], top[place]
        return n, best


def is_best(pair: np.ndarray, n: np.ndarray) -> np.ndarray:
    most = np.zeros(WIDTH, np.int64)
    np.maximum.at(most, pair >> 16, n)
    return n == most[pair >> 16]


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def digest_rows(table: Units, doc_ids: list, found: list[np.ndarray | None]) -> dict[str, list]:
    """The columns of RESULT that need no counts."""
    import hashlib

    rows: dict[str, list] = {"doc_id": doc_ids, "n_a": [], "n_b": [], "n_groups": [], "n_links": [], "groups_sha256": []}
    for own in found:
        numbers = [0] * 4 if own is None else table.number[1:5, own].sum(axis=1).tolist()
        for name, value in zip(("n_a", "n_b", "n_groups", "n_links"), numbers, strict=True):
            rows[name].append(value)
        text = None if own is None else b";".join(map(table.text.__getitem__, own.tolist()))
        rows["groups_sha256"].append("" if text is None else hashlib.sha256(text).hexdigest())
    return rows


def scored_here(docs: DataFrame, paths: tuple[str, str], counts: DataFrame, buckets: int) -> DataFrame:
    """RESULT by a table of counts that is sent to all tasks."""
    sent = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in counts.collect()])
    names = [x.split()[0] for x in RESULT.split(", ")]
    schema = pa.schema([(c, pa.string() if c == "groups_sha256" else pa.int64()) for c in names])

    def run(batches):
        aligner, known = Aligner.of(*paths), Counts(sent.value)
        for b in pieces(batches, 256):
            table, found = aligner.rows_of([t or "" for t in b["text"].to_pylist()])
            rows = digest_rows(table, b["doc_id"].to_pylist(), found)
            used = [x for x in found if x is not None]
            units = np.unique(np.concatenate(used)) if used else np.zeros(0, np.int64)
            which, at = pairs_of(table, units)
            n, best = known.look_up(table.pair[at], buckets)
            # of each unit, then of each document
            sums = np.zeros((2, len(table.text)), np.int64)
            np.add.at(sums[0], units[which], best * table.times[at])
            np.add.at(sums[1], units[which], n * table.times[at])
            for name, own in zip(("n_best", "count_sum"), sums, strict=True):
                rows[name] = [0 if x is None else int(own[x].sum()) for x in found]
            yield batch(schema, rows)

    return docs.select(F.col("doc_id").cast("long"), text_column().alias("text")).mapInArrow(run, RESULT)


def scored_by_join(docs: DataFrame, paths: tuple[str, str], counts: DataFrame) -> DataFrame:
    """RESULT by a join of the documents' distinct pairs with the counts."""
    names = [x.split()[0] for x in RESULT.split(", ") if x.split()[0] not in ("n_best", "count_sum")]
    lists = ["pairs", "times"]
    kinds = {"groups_sha256": pa.string(), **dict.fromkeys(lists, pa.list_(pa.int64()))}
    schema = pa.schema([(c, kinds.get(c, pa.int64())) for c in names + lists])

    def run(batches):
        aligner = Aligner.of(*paths)
        for b in pieces(batches, 64):
            table, found = aligner.rows_of([t or "" for t in b["text"].to_pylist()])
            rows = digest_rows(table, b["doc_id"].to_pylist(), found)
            rows |= {"pairs": [], "times": []}
            for own in found:
                at = pairs_of(table, np.zeros(0, np.int64) if own is None else own)[1]
                _, pair, times = unique_rows(np.zeros(len(at)), table.pair[at], table.times[at])
                rows["pairs"].append(pair)
                rows["times"].append(times)
            yield batch(schema, rows)

    ddl = ", ".join(f"{c} string" if c == "groups_sha256" else f"{c} long" for c in names)
    aligned = docs.select(F.col("doc_id").cast("long"), text_column().alias("text")).mapInArrow(
        run, f"{ddl}, pairs array<long>, times array<long>"
    )
    # numbers of rows hold once they are written
    aligned = stored(aligned.withColumn("row", F.monotonically_increasing_id()))
    flat = pa.schema([("pair", pa.int64()), ("n", pa.int64()), ("best", pa.bool_())])

    def spread(batches: Iterator[pa.RecordBatch]):
        for b in pieces(batches, 1):
            for pairs, n in zip(b["pairs"].to_pylist(), b["counts"].to_pylist(), strict=True):
                pair, own = np.frombuffer(pairs, np.int64), np.frombuffer(n, np.int64)
                yield batch(flat, {"pair": pa.array(pair), "n": pa.array(own), "best": pa.array(is_best(pair, own))})

    table = stored(counts.select("pairs", "counts").mapInArrow(spread, "pair long, n long, best boolean"))
    linked = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    linked = linked.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    sums = linked.join(table, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    )
    joined = aligned.drop("pairs", "times").join(sums, "row", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return joined.select(*names[:-1], *zero, "groups_sha256")


@in_scope
def aligned_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: doc_id, n_a and n_b (its tokens), n_groups, n_links, n_best (links whose count
    is the highest of their first id), count_sum (of the counts, over links), groups_sha256.

    Texts that are null, empty, or that the tokens of either tokenizer do not spell have zeros and
    an empty digest, and count for no pair.  Repeated rows count again; null ids stay null; a long
    text is aligned in blocks; an empty table gives no rows."""
    counts = stored(pair_counts(docs, (path_a, path_b)))
    distinct = counts.select("pair").distinct().count()
    buckets = max(1, min(BUCKETS, -(-distinct // BUCKET)))
    hashed = stored(hashes(counts, buckets))
    found = stored(hashed.join(count_vectors(counts, hashed, buckets), "bucket"))
    found = found.select("bucket", "hash", "pairs", "counts")
    if distinct <= SENT_PAIRS:
        return scored_here(docs, (path_a, path_b), found, buckets)
    return scored_by_join(docs, (path_a, path_b), found)
