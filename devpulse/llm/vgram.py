"""Spelling variants by variable-length grams.

Words lie between two sentinels, in grams of `QMIN` to `QMAX` symbols.  A gram longer than `QMIN`
is in the dictionary if the gram without its last symbol is frequent among the words.  A word is
cut greedily: at each place the longest gram of the dictionary, or else `QMIN` symbols, unless a
gram before it covers it.

An edit at one place changes the grams that hold the place and those beside it which a gram of the
dictionary could swallow across it, known from the dictionary's beginnings and ends.  The most that
any one place can change is the word's bound.  Two near words have all other grams in common, so of
the `bound + 1` rarest grams of each one is the same in both, in the same place or one to the right.
These alone go into the lists.  (With `SHORTEST` symbols or more no bound takes all grams: an edit
spares the first gram or the last.)

A list is merged under a longer key: one edit leaves one half of what lies around a common gram as
it is, so the key has the gram, its place, and either half; one key is enough where a half is no
more than a sentinel.  Lists are joined by key and what meets is verified."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.llm.common import batch, stored, text_column
from devpulse.sources.sinks import in_scope

QMIN, QMAX = 2, 4
# fewest code points of a word; with the sentinels, twice QMAX and one
SHORTEST = 2 * QMAX - 1
# a gram is frequent if it makes more than one in PARTS of all; so at most PARTS are, and the
# dictionary has at most 92 entries for each of those, 16 bytes an entry
PARTS = 20_000
# runs of a task that are counted before they go out
HELD = 300_000
# deletions: one run in DELETED loses a code point
DELETED = 31
# a form occurs this many times as often
TIMES = 10

# symbols: 1 and 2 begin and end a word, then a-z and U+00C0 to U+00FF
SYMBOL = np.zeros(256, np.int64)
SYMBOL[97:123] = np.arange(3, 29)
SYMBOL[0xC0:0x100] = np.arange(29, 93)
SHIFT = 7
# what parts of a word are hashed with: a number a symbol, and the odd base of a polynomial
VALUES = np.random.default_rng(13).integers(0, 2**63, 128).astype(np.uint64)
BASE = 0x9E3779B97F4A7C15
FIELDS = np.random.default_rng(14).integers(0, 2**63, 8).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def runs(text: str, doc_id: int | None, shortest: int) -> Counter:
    """The text's runs of letters of `shortest` code points or more, with their counts; A-Z are
    lower case, and runs whose hash asks for it lack a code point."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter = Counter()
    low = text.encode().lower().decode()
    for run, n in Counter(re.findall(f"[a-zÀ-ÿ]{{{shortest},}}", low)).items():
        h = zlib.crc32(run.encode(), start)
        if h % DELETED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= shortest:
            found[run] += n
    return found


def words_of(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(word, n): the words of all texts that occur twice or more."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        total: Counter = Counter()
        for b in batches:
            for doc, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                total.update(runs(text, doc, shortest))
                if len(total) > HELD:
                    yield batch(schema, {"word": list(total), "n": list(total.values())})
                    total = Counter()
        yield batch(schema, {"word": list(total), "n": list(total.values())})

    texts = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    counted = texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where("n >= 2")


def matrices(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, symbols) of the words of each length, sentinels included."""
    by_length: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        by_length[len(w)].append(i)
    found = []
    for n, rows in by_length.items():
        data = "".join([words[i] for i in rows]).encode("latin-1")
        symbols = np.empty((len(rows), n + 2), np.int64)
        symbols[:, 0], symbols[:, -1] = 1, 2
        symbols[:, 1:-1] = SYMBOL[np.frombuffer(data, np.uint8)].reshape(len(rows), n)
        found.append((np.array(rows), symbols))
    return found


def codes(symbols: np.ndarray, q: int) -> np.ndarray:
    """The number of the gram of q symbols at each place; longer grams have larger numbers."""
    places = symbols.shape[1] - q + 1
    total = np.zeros((len(symbols), places), np.int64)
    for k in range(q):
        total = (total << SHIFT) | symbols[:, k : k + places]
    return total


def gram_counts(words: DataFrame) -> DataFrame:
    """(code, q, n) of all grams of QMIN to QMAX symbols in the words."""
    schema = pa.schema([("code", pa.int64()), ("q", pa.int32()), ("n", pa.int64())])

    def run(batches):
        for b in batches:
            cut = [m for _, m in matrices(b["word"].to_pylist())]
            for q in range(QMIN, QMAX + 1) if cut else ():
                code, n = np.unique(np.concatenate([codes(m, q).ravel() for m in cut]), return_counts=True)
                yield batch(schema, {"code": pa.array(code), "q": [q] * len(code), "n": pa.array(n)})

    found = words.select("word").mapInArrow(run, "code long, q int, n long")
    return found.groupBy("code", "q").agg(F.sum("n").alias("n"))


class Dictionary:
    """The grams that words are cut into, and how frequent each is."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        rows = sorted(rows)
        self.code = np.array([r[0] for r in rows], np.int64)
        self.n = np.array([r[2] for r in rows], np.int64)
        q = np.array([r[1] for r in rows], np.int64)
        self.of = {k: self.code[q == k] for k in range(QMIN, QMAX + 1)}
        # proper beginnings and ends of the dictionary's grams, by length
        longer = {k: [(j, self.of[j]) for j in range(k + 1, QMAX + 1)] for k in range(QMIN, QMAX)}
        self.begins = {k: np.unique(np.concatenate([c >> SHIFT * (j - k) for j, c in v])) for k, v in longer.items()}
        self.ends = {k: np.unique(np.concatenate([c & ((1 << SHIFT * k) - 1) for j, c in v])) for k, v in longer.items()}

    @classmethod
    def learn(cls, words: DataFrame) -> "Dictionary":
        """Of a bounded number of entries, which come to the driver."""
        counts = stored(gram_counts(words))
        total = counts.where(F.col("q") == QMIN).agg(F.sum("n")).first()[0] or 0
        shorter = counts.where(F.col("n") * PARTS > total).select(F.col("code").alias("stem"))
        stem = F.shiftright("code", SHIFT)
        kept = counts.where(F.col("q") == QMIN)
        before = shorter
        for q in range(QMIN + 1, QMAX + 1):
            level = counts.where(F.col("q") == q).join(before, stem == F.col("stem"), "left_semi")
            kept = kept.union(level)
            # the next level's stems must be in the dictionary themselves
            before = shorter.join(level.select(F.col("code").alias("stem")), "stem", "left_semi")
        return cls([tuple(r) for r in kept.collect()])

    def cut(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length, whether it is a gram of the word) of the longest gram at each place."""
        places = symbols.shape[1] - QMIN + 1
        length = np.full((len(symbols), places), QMIN)
        for q in range(QMIN + 1, QMAX + 1):
            known = np.isin(codes(symbols, q), self.of[q])
            length[:, : known.shape[1]][known] = q
        end = np.arange(places) + length
        kept = np.ones_like(end, bool)
        kept[:, 1:] = end[:, 1:] > np.maximum.accumulate(end, axis=1)[:, :-1]
        return length, kept

    def bounds(self, symbols: np.ndarray, length: np.ndarray, kept: np.ndarray) -> np.ndarray:
        """The most grams of each word that one edit can change."""
        rows, n = symbols.shape
        pad = QMAX
        # by length, gram starts with room on both sides
        starts = np.zeros((QMAX + 1, rows, n + 2 * pad), np.int64)
        for q in range(QMIN, QMAX + 1):
            starts[q, :, pad : pad + length.shape[1]] = kept & (length == q)

        def at(q: int, shift: int) -> np.ndarray:
            return starts[q, :, pad + shift : pad + shift + n]

        def inside(first: int, width: int) -> np.ndarray:
            """Grams within the `width` symbols from `first` on, for each place."""
            return sum(at(q, first + k) for q in range(QMIN, width + 1) for k in range(width - q + 1))

        spans = [(q, k) for q in range(QMIN, QMAX + 1) for k in range(q)]
        held = sum(at(q, -k) for q, k in spans)
        crossed = sum(at(q, -k) for q, k in spans if k)
        left, right = (np.zeros((rows, n), np.int64) for _ in range(2))
        for w in range(QMIN, QMAX):
            code = codes(symbols, w)
            begins = np.isin(code, self.begins[w])[:, : n - w]
            left[:, w:] = np.where(begins, inside(-w, w)[:, w:], left[:, w:])
            ends = np.isin(code, self.ends[w])[:, 1:]
            right[:, : n - w] = np.where(ends, inside(1, w)[:, : n - w], right[:, : n - w])
        replaced = (held + left + right)[:, 1:-1].max(axis=1)
        inserted = (crossed[:, 1:] + left[:, 1:] + right[:, :-1]).max(axis=1)
        return np.maximum(replaced, inserted)

    def chosen(self, symbols: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, place, length, code) of the rarest grams of each word, one more than its bound."""
        length, kept = self.cut(symbols)
        code = np.zeros(length.shape, np.int64)
        for q in range(QMIN, QMAX + 1):
            here = length[:, : symbols.shape[1] - q + 1] == q
            code[:, : here.shape[1]][here] = codes(symbols, q)[here]
        n = self.n[np.searchsorted(self.code, code)]
        # by frequency, code and place; grams that are none last
        last = np.iinfo(np.int64).max
        order = np.lexsort((np.broadcast_to(np.arange(code.shape[1]), code.shape), code, np.where(kept, n, last)))
        most = np.minimum(self.bounds(symbols, length, kept) + 1, kept.sum(axis=1))
        row, rank = np.nonzero(np.arange(code.shape[1]) < most[:, None])
        place = order[row, rank]
        return row, place, length[row, place], code[row, place]


class Hashes:
    """Numbers of stretches of words of one length, equal wherever the symbols are."""

    def __init__(self, symbols: np.ndarray):
        n = symbols.shape[1]
        power = np.array([pow(BASE, i, 2**64) for i in range(n + 1)], np.uint64)
        self.back = np.array([pow(BASE, -i, 2**64) for i in range(n + 1)], np.uint64)
        self.sums = np.zeros((len(symbols), n + 1), np.uint64)
        np.cumsum(VALUES[symbols] * power[:n], axis=1, out=self.sums[:, 1:])

    def of(self, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[row, end] - self.sums[row, start]) * self.back[start]


def keyed(fields: list[np.ndarray]) -> np.ndarray:
    total = np.zeros(len(fields[0]), np.uint64)
    for value, times in zip(fields, FIELDS, strict=False):
        total = (total ^ (total >> np.uint64(29))) * times + np.asarray(value).astype(np.uint64) * times
    return (total ^ (total >> np.uint64(32))).view(np.int64)


def list_entries(
    dictionary: Dictionary, symbols: np.ndarray, roles: tuple[int, ...] = (0, 1, 2)
) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(role, row, key): 0 for meeting words of the same length, 1 as the shorter of two words,
    2 as the longer."""
    row, p, q, code = dictionary.chosen(symbols)
    n = symbols.shape[1]
    hashes, end, found = Hashes(symbols), p + q, []
    left, right = p, n - end
    none = np.zeros_like(p)

    def add(role: int, size: int, place: np.ndarray, case: int, ok: np.ndarray, one, two) -> None:
        parts = [hashes.of(row, *x) for x in (one, two)]
        fields = [np.full(len(row), size), place, code, np.full(len(row), case), *parts]
        found.append((role, row[ok], keyed(fields)[ok]))

    if 0 in roles:
        # the same length: half of what is around the gram
        half = (left + right) // 2
        before, after = np.minimum(half, left), np.maximum(half - left, 0)
        every = np.ones(len(p), bool)
        add(0, n, p, 0, every, (none, before), (end, end + after))
        add(0, n, p, 1, every, (before, left), (end + after, none + n))
    for role, more in ((1, 0), (2, 1)):
        if role not in roles:
            continue
        # of two lengths, cases by the side of the edit; `more` symbols are in the longer word alone.
        # of two symbols or one, a half is empty or the sentinel: the same in all words, and enough
        longer, whole = n + 1 - more, right - more
        half = np.maximum(whole, 0) // 2
        add(role, longer, p, 2, whole > 2, (none, left), (end, end + half))
        add(role, longer, p, 3, whole > 0, (none, left), (np.minimum(n - whole + half, n), none + n))
        whole = left - more
        half = np.maximum(whole, 0) // 2
        place = p + 1 - more
        add(role, longer, place, 4, whole > 0, (none, half), (end, none + n))
        add(role, longer, place, 5, whole > 2, (np.maximum(left - whole + half, 0), left), (end, none + n))
    return found


def near_pairs(words: DataFrame, dictionary: Dictionary) -> DataFrame:
    """(a, na, b, nb) of all words (word, n) that differ by one edit, both ways round."""
    sent = words.sparkSession.sparkContext.broadcast(dictionary)
    schema = pa.schema([("key", pa.int64()), ("word", pa.string()), ("n", pa.int64())])

    # entries are many times the words, so each role's go from the words right into their shuffle
    def entries(role: int) -> DataFrame:
        def run(batches):
            for b in batches:
                word, n = b["word"], b["n"]
                for rows, symbols in matrices(word.to_pylist()):
                    for _, row, key in list_entries(sent.value, symbols, (role,)):
                        at = pa.array(rows[row])
                        yield batch(schema, {"key": pa.array(key), "word": word.take(at), "n": n.take(at)})

        return words.mapInArrow(run, "key long, word string, n long")

    near = F.levenshtein("a", "b", 1) == 1

    def side(found: DataFrame, name: str) -> DataFrame:
        return found.select("key", F.col("word").alias(name), F.col("n").alias(f"n{name}"))

    alike = entries(0)
    same = side(alike, "a").join(side(alike, "b"), "key").where((F.col("a") < F.col("b")) & near)
    other = side(entries(1), "a").join(side(entries(2), "b"), "key").where(near)
    pairs = stored(same.union(other).select("a", "na", "b", "nb").distinct())
    return pairs.union(pairs.select("b", "nb", "a", "na"))


def with_roots(formed: DataFrame) -> DataFrame:
    """`formed` (word, form, ...) with `root`: forms followed to the last.  A form occurs ten times
    as often as its word, so a chain is short; each round doubles what has been followed."""
    step = stored(formed.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        to = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = step.join(to, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further")
        joined = stored(joined)
        step = joined.select("word", "root")
        if joined.where("further is not null").isEmpty():
            return formed.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))


@in_scope
def spelling_variants(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    Null and empty texts have no words; of a null doc_id nothing is written before the colon when
    a run is hashed; repeated rows count again.  Of equally frequent near words the first in code
    point order is the form.  A run of any length is one word.  Tables without words give no rows."""
    if shortest < SHORTEST:
        raise ValueError(f"words have {SHORTEST} code points at least")
    words = stored(words_of(docs, shortest))
    pairs = near_pairs(words, Dictionary.learn(words))
    most = F.min(F.struct((-F.col("nb")).alias("less"), F.col("b").alias("form"))).alias("most")
    around = pairs.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), most)
    joined = words.join(around, "word", "left")
    often = -F.col("most.less") >= TIMES * F.col("n")
    formed = joined.select(
        "word",
        F.when(often, F.col("most.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, -F.col("most.less")).alias("form_n"),
    )
    return with_roots(stored(formed)).select("word", "form", "root", "n", "n_near", "form_n")
