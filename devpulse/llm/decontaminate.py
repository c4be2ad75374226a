"""Benchmark decontamination: rare n-gram seeds, then local alignment.

A first pass over the corpus counts the documents that hold each n-gram of a test item, of `N` to
`LONGEST` words.  From every place of an item the shortest of them that is rare becomes a seed:
held by few documents for the corpus's size and by few items.  One that no document holds seeds
nothing, so an edit takes only the seeds it touches.  A common n-gram counts only together with the
words behind it, until it is rare or `LONGEST` words long; so neither a phrase that thousands of
items share nor one that is all over the corpus makes pairs.

A document and an item with a seed in common are aligned around the places where their diagonals
agree, by Smith-Waterman over words: the score counts matching words less changes and gaps, and
`share` is that score against the item's own.

Items of up to `SENT_WORDS` words in all go to every task; of more, seeds are joined with the
documents' n-grams by a shuffle.

Words are those between blanks, A-Z in lower case, without ASCII punctuation.  A text of fewer
words than an n-gram has is one shorter n-gram, so such an item meets only texts as short.  Null texts count as empty and match nothing; null
ids stay null; repeated rows of a document are matched each on their own, repeated items count
once; an empty table on either side gives no rows."""

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.llm.common import batch, pieces, stored, text_column, utf8, words

N, LONGEST = 3, 6
# score of a match, of a changed word, of a gap of one word
MATCH, CHANGE, GAP = 2, -1, -1
SHARE = 0.5
# an n-gram is rare if at most one document in RARE holds it, or FEW, and at most HOLDERS items
RARE, FEW, HOLDERS = 1000, 100, 16
# words of test items that go to every task; four n-grams a word come to the driver
SENT_WORDS = 200_000
# bits that say which n-grams may be in an item, where the items are too many to be sent
BITS = 1 << 26
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
TURNS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 2**64) for i in range(LONGEST)], np.uint64)


def clean_words(data: bytes) -> list[bytes]:
    return words(data.translate(None, PUNCTUATION))


def word_number(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) or 1


def grams(ids: np.ndarray, n: int) -> np.ndarray:
    """The n-grams of a text as numbers, from the numbers of its words, of which 0 is a word of no
    item; 0 where an n-gram has such a word.  Of fewer words than N, all of them."""
    n = min(n, len(ids)) if n == N else n
    count = max(0, len(ids) - n + 1) if n else 0
    out, known = np.zeros(count, np.uint64), np.ones(count, bool)
    for i in range(n):
        part = ids[i : i + count]
        out += part * TURNS[i]
        known &= part != 0
    return np.where(known, out | np.uint64(1), np.uint64(0))


def among(own: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in `own` of values that the sorted array `wanted` has; 0 is none."""
    places = np.flatnonzero(own)
    if not len(wanted) or not len(places):
        return places[:0]
    values = own[places]
    at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    return places[wanted[at] == values]


def align(a: list[bytes], b: list[bytes]) -> tuple[int, int, int]:
    """Smith-Waterman: (best score, start and end in b of the stretch that gives it).

    A row at a time: the best without a gap along the row is taken for all columns at once, and
    gaps along the row follow from a running maximum."""
    if not a or not b:
        return 0, 0, 0
    number = {w: i for i, w in enumerate(dict.fromkeys([*a, *b]))}
    other = np.array([number[w] for w in b])
    slope = GAP * np.arange(len(b) + 1)
    before, begins = np.zeros(len(b) + 1, np.int64), np.arange(len(b) + 1)
    best = (0, 0, 0)
    for w in a:
        turn = np.where(other == number[w], MATCH, CHANGE)
        score = np.zeros(len(b) + 1, np.int64)
        begin = np.arange(len(b) + 1)
        diagonal, down = before[:-1] + turn, before[1:] + GAP
        score[1:] = np.maximum(diagonal, down)
        begin[1:] = np.where(diagonal >= down, begins[:-1], begins[1:])
        fresh = score <= 0
        score[fresh] = 0
        begin[fresh] = np.arange(len(b) + 1)[fresh]
        # a gap along the row: the largest score to the left, less its distance
        level = score - slope
        at = np.maximum.accumulate(np.where(level == np.maximum.accumulate(level), np.arange(len(b) + 1), 0))
        along = level[at] + slope
        begin = np.where(along > score, begin[at], begin)
        score = np.maximum(score, along)
        end = int(score.argmax())
        if score[end] > best[0]:
            best = (int(score[end]), int(begin[end]), end)
        before, begins = score, begin
    return best


def stretches(hits: list[tuple[int, int]], length: int, total: int) -> Iterator[tuple[int, int]]:
    """Where to align: the reach of the item around each hit (place in the document, place in the
    item), with half its length to spare, joined where they overlap."""
    spare = length // 2 + N
    spans = sorted((max(0, p - q - spare), min(total, p - q + length + spare)) for p, q in hits)
    at = None
    for s, e in spans:
        if at and s <= at[1]:
            at = (at[0], max(at[1], e))
        else:
            if at:
                yield at
            at = (s, e)
    if at:
        yield at


def matches_of(found: list[bytes], hits: list[tuple[int, int]], item: list[bytes], least: float):
    """(share, start, end) of the best alignment of the item near the hits; words of the document.
    A stretch is passed over if even all the item's words that it holds can't reach `least`."""
    best = (0.0, 0, 0)
    for s, e in stretches(hits, len(item), len(found)):
        there = set(found[s:e])
        if sum(w in there for w in item) < least * len(item):
            continue
        score, start, end = align(item, found[s:e])
        if score / (MATCH * len(item)) > best[0]:
            best = (score / (MATCH * len(item)), s + start, s + end)
    return best


def item_words(benchmark: DataFrame) -> DataFrame:
    """(item_id, words): one row per distinct item."""
    schema = pa.schema([("item_id", pa.int64()), ("words", pa.list_(pa.binary()))])

    def run(batches):
        for b in pieces(batches):
            yield batch(schema, {"item_id": b["item_id"], "words": [clean_words(x) for x in utf8(b["text"])]})

    items = benchmark.select(F.col("item_id").cast("long"), text_column().alias("text")).distinct()
    return items.mapInArrow(run, "item_id long, words array<binary>")


RESULT = "doc_id long, item_id long, share double, start long, end long"


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, share, start, end): documents with a stretch that aligns with a test item
    by at least `share` of the item's own score; start and end count the document's words."""
    items = stored(item_words(benchmark))
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    if total <= SENT_WORDS:
        rows = items.orderBy("item_id", "words").collect()
        return aligned(docs, [r.asDict() for r in rows], share)
    return joined(docs, items, share)


class Items:
    """Test items that are sent to all tasks: their words, and the numbers of these."""

    def __init__(self, items: list[dict]):
        self.items = items
        self.number = {w: word_number(w) for item in items for w in item["words"]}
        self.ids = [self.numbers(item["words"]) for item in items]

    def numbers(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.get, found, repeat(0)), np.uint64, len(found))

    def grams(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(item, n, its n-grams)."""
        for i, ids in enumerate(self.ids):
            for n in range(N, LONGEST + 1):
                yield i, n, grams(ids, n)

    def seeds(self, held: dict[int, int], docs: int) -> dict[int, dict[int, list[tuple[int, int]]]]:
        """By length and n-gram, the (item, place) it seeds."""
        own = defaultdict(dict)
        holders: dict[int, int] = defaultdict(int)
        for i, n, numbers in self.grams():
            own[i][n] = numbers.tolist()
            for g in set(own[i][n]):
                holders[g] += 1
        most = max(FEW, docs // RARE)
        out: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for i, by_length in own.items():
            for place in range(len(by_length[N])):
                for n in range(N, LONGEST + 1):
                    # an item too short to go on from here is taken as it is
                    last = n == LONGEST or (place == 0 and not by_length[n + 1])
                    if place >= len(by_length[n]):
                        break
                    g = by_length[n][place]
                    if last or (held.get(g, 0) <= most and holders[g] <= HOLDERS):
                        if held.get(g, 0):
                            out[n][g].append((i, place))
                        break
        return {n: dict(x) for n, x in out.items()}


def gram_documents(docs: DataFrame, items: Items) -> tuple[dict[int, int], int]:
    """How many documents hold each n-gram of an item, and how many there are."""
    wanted = {n: np.zeros(0, np.uint64) for n in range(N, LONGEST + 1)}
    for _, n, numbers in items.grams():
        wanted[n] = np.append(wanted[n], numbers)
    wanted = {n: np.unique(x) for n, x in wanted.items()}
    sent = docs.sparkSession.sparkContext.broadcast((items.number, wanted))
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def run(batches):
        number, wanted = sent.value
        held, docs_seen = [np.zeros(0, np.uint64)], 0
        for b in pieces(batches):
            for data in utf8(b["text"]):
                found = clean_words(data)
                ids = np.fromiter(map(number.get, found, repeat(0)), np.uint64, len(found))
                for n, values in wanted.items():
                    own = grams(ids, n)
                    held.append(np.unique(own[among(own, values)]))
                docs_seen += 1
            total, n = np.unique(np.concatenate(held), return_counts=True)
            yield batch(schema, {"gram": pa.array(total.view(np.int64)), "n": pa.array(n)})
            held = held[:1]
        # how many documents there are goes under 0, which is no n-gram
        yield batch(schema, {"gram": [0], "n": [docs_seen]})

    found = docs.select(text_column().alias("text")).mapInArrow(run, "gram long, n long")
    rows = found.groupBy("gram").agg(F.sum("n").alias("n")).collect()
    held = {r["gram"] % 2**64: r["n"] for r in rows}
    return held, held.pop(0, 0)


def alignments(found: list[bytes], hits: dict, words_of: dict, share: float) -> Iterator[tuple]:
    """(item, share, start, end) of the items that align, of those with hits."""
    for item, places in hits.items():
        got, start, end = matches_of(found, places, words_of[item], share)
        if got >= share:
            yield item, got, start, end


def aligned(docs: DataFrame, rows: list[dict], share: float) -> DataFrame:
    items = Items(rows)
    index = items.seeds(*gram_documents(docs, items)) if rows else {}
    words_of = {i: r["words"] for i, r in enumerate(rows)}
    ids_of = [r["item_id"] for r in rows]
    sent = docs.sparkSession.sparkContext.broadcast((words_of, ids_of, items.number, index))
    schema = result_schema()

    def run(batches):
        words_of, ids_of, number, index = sent.value
        seeded = {n: np.array(sorted(x), np.uint64) for n, x in index.items()}
        for b in pieces(batches):
            out: list[tuple] = []
            for doc, data in zip(b["doc_id"].to_pylist(), utf8(b["text"]), strict=True):
                found = clean_words(data)
                ids = np.fromiter(map(number.get, found, repeat(0)), np.uint64, len(found))
                hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
                for n, values in seeded.items():
                    own = grams(ids, n)
                    for p in among(own, values).tolist():
                        for item, q in index[n][int(own[p])]:
                            hits[item].append((p, q))
                for item, *rest in alignments(found, hits, words_of, share):
                    out.append((doc, ids_of[item], *rest))
            yield batch(schema, dict(zip(schema.names, zip(*out, strict=True), strict=True)) if out else {n: [] for n in schema.names})

    return docs.select(F.col("doc_id").cast("long"), text_column().alias("text")).mapInArrow(run, RESULT)


def result_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "double": pa.float64()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in RESULT.split(", "))])


def placed_grams(frame: DataFrame, key: str, words_column: str | None, bits=None) -> DataFrame:
    """(key, n, gram, place) of the n-grams of every row, only those that `bits` allow."""
    schema = pa.schema([(key, pa.int64()), ("n", pa.int32()), ("gram", pa.int64()), ("place", pa.int64())])
    known = None if bits is None else frame.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for b in pieces(batches, 64):
            texts = [clean_words(x) for x in utf8(b["text"])] if words_column is None else b[words_column].to_pylist()
            for k, found in zip(b[key].to_pylist(), texts, strict=True):
                ids = np.fromiter(map(word_number, found), np.uint64, len(found))
                for n in range(N, LONGEST + 1):
                    own = grams(ids, n)
                    at = np.arange(len(own))
                    if known is not None:
                        place = (own % np.uint64(BITS)).astype(np.int64)
                        at = np.flatnonzero(known.value[place >> 3] >> (place & 7).astype(np.uint8) & 1)
                    columns = {key: [k] * len(at), "n": [n] * len(at), "gram": pa.array(own[at].view(np.int64)), "place": pa.array(at)}
                    yield batch(schema, columns)

    return frame.mapInArrow(run, f"{key} long, n int, gram long, place long")


def allowed_bits(grams_of_items: DataFrame) -> np.ndarray:
    """A bit for each n-gram of an item; BITS in all, whatever the items are."""
    place = F.pmod(F.col("gram"), F.lit(BITS)) + 1  # both functions count from 1
    rows = (
        grams_of_items.select(F.bitmap_bucket_number(place).alias("k"), F.bitmap_bit_position(place).alias("at"))
        .groupBy("k")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
    )
    out = np.zeros(BITS // 8, np.uint8)
    for r in rows.toLocalIterator():
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        start = (r["k"] - 1) * len(part)
        out[start : start + len(part)] = part
    return out


def joined(docs: DataFrame, items: DataFrame, share: float) -> DataFrame:
    """`aligned` by shuffles: for items of any number."""
    numbered = stored(items.withColumn("item", F.monotonically_increasing_id()))
    own = stored(placed_grams(numbered.select("item", "words"), "item", "words"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"), F.xxhash64("doc_id", text_column()).alias("row"))
    found = stored(placed_grams(texts.select("row", "text"), "row", None, allowed_bits(own)).distinct())
    held = found.select("gram", "n", "row").distinct().groupBy("gram", "n").agg(F.count("*").alias("held"))
    holders = own.select("gram", "n", "item").distinct().groupBy("gram", "n").agg(F.count("*").alias("holders"))
    most = max(FEW, docs.count() // RARE)
    rare = (F.col("held") <= most) & (F.col("holders") <= HOLDERS)
    # the item's last length from a place: LONGEST, or all of a short item
    sizes = numbered.select("item", F.size("words").alias("size"))
    counted = own.join(held, ["gram", "n"], "left").join(holders, ["gram", "n"]).join(sizes, "item")
    last = (F.col("n") == LONGEST) | ((F.col("place") == 0) & (F.col("n") >= F.least(F.col("size"), F.lit(LONGEST))))
    usable = counted.where(last | F.col("held").isNull() | rare)
    first = usable.groupBy("item", "place").agg(F.min(F.struct("n", "gram", "held")).alias("x"))
    seeds = first.where("x.held > 0").select("item", F.col("place").alias("q"), "x.n", "x.gram")
    hits = found.join(seeds, ["gram", "n"]).groupBy("row", "item").agg(F.collect_set(F.struct("place", "q")).alias("hits"))
    pairs = hits.join(numbered, "item").join(texts, "row").select("doc_id", "text", "item_id", "words", "hits")
    schema = result_schema()

    def run(batches):
        for b in pieces(batches, 64):
            out: list[tuple] = []
            columns = [b[c].to_pylist() for c in ("doc_id", "item_id", "words", "hits")]
            for doc, item, words_, hits, data in zip(*columns, utf8(b["text"]), strict=True):
                places = [(h["place"], h["q"]) for h in hits]
                for _, *rest in alignments(clean_words(data), {0: places}, {0: words_}, share):
                    out.append((doc, item, *rest))
            yield batch(schema, dict(zip(schema.names, zip(*out, strict=True), strict=True)) if out else {n: [] for n in schema.names})

    return pairs.mapInArrow(run, RESULT)


def without_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """`docs` without the documents that hold a leaked test item, all columns kept.  Rows of a null
    id, which no match can name, are told apart by their text."""
    found = stored(contaminated(docs.withColumn("doc_id", row_key()), benchmark, share).select("doc_id").distinct())
    own = docs.select(F.struct([F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_key().alias("key"))
    return own.join(found, own["key"] == found["doc_id"], "left_anti").select("doc.*")


def row_key():
    """A key of a row's id and text."""
    return F.xxhash64("doc_id", "text")
