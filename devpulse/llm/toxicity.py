"""Toxicity of whole texts, written plainly or disguised.

Disguised words (letters replaced by digits and signs, letters or pieces set apart, letters repeated) are
restored by a Viterbi search: the characters give a lattice of letters that may have been meant,
with costs of a noisy channel, and a model of three characters in a row finds the likeliest word.
The restored text is then scored: each word counts by its most telling feature (itself or how it
begins), and a logistic curve turns a text's largest weight (and its square) and their sum into a score.

Character counts cover all documents.  Labels are learned from a sample of at most `LABELLED`
labelled documents (those of smallest id hash) outside the held-out fold; the features kept are at
most `FEATURES`.  Null texts count as empty, documents without any feature get the curve's lowest
value; null ids are held out; labels that contradict count as toxic; without labels of both kinds
every score is 0.  An empty table gives no rows."""

import re
from collections import Counter
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.llm.common import batch, fold, labelled_sample, pieces, stored, text_column, utf8, words

FOLDS, HELD = 3, 1
THRESHOLD = 0.7
LABELLED = 20_000
FEATURES = 20_000
# toxic documents a feature must be in, and the share of them, and least logarithm of its odds ratio
LEAST_DOCUMENTS = 4
LEAST_SHARE = 0.01
LEAST_WEIGHT = 2.5
BEGINNINGS = (4, 5, 6)
# words a worker remembers
CACHED = 400_000

# characters of the model: 0 the edge of a word, 1 to 26 letters, 27 any other letter
SYMBOLS = 28
# fixed values: letters that digits and signs stand for
MEANT = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "h",
}
APART = ".-_*~/"
EDGES = "\"'.,;:?()[]{}<>%&#*-_=/\\~^`"
STRANGE = re.compile(r"[0-9@$!|+(*#]|([^\W\d_])\1|[^\W\d_][.\-_*~/][^\W\d_]")
LETTER = re.compile(r"[^\W\d_]")
# letters of which no two in a row are equal, which can only have been meant as they are
UNDISGUISED = re.compile(r"(?:([^\W\d_])(?!\1))*\Z")
# most characters of a piece of a word, and fewest of a word, that is set apart
PIECE, WHOLE = 2, 4
# costs of the channel, as logarithms
REPLACED, GUESSED, DROPPED, SHORTENED = -0.7, -1.6, -0.2, -1.5


class Speller(NamedTuple):
    """log P(third | first two) by symbols."""

    logs: np.ndarray


class Judge(NamedTuple):
    speller: Speller
    weights: dict[str, float]
    curve: tuple[float, ...]  # of one, the largest weight, its square, and the sum


def code(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 27 if LETTER.match(char) else 0


def options(char: str, length: int) -> list[tuple[str, float]]:
    """What a run of a character may have been meant as, and the cost."""
    out: list[tuple[str, float]] = []
    if LETTER.match(char):
        out = [(char, 0.0 if length != 2 else SHORTENED)]
        if length > 1:
            out.append((char * 2, 0.0 if length == 2 else SHORTENED))
    for meant in MEANT.get(char, ""):
        cost = GUESSED if char == "*" else REPLACED
        out.append((meant, cost))
        if length > 1:
            out.append((meant * 2, cost))
    if char in APART or not out:
        out.append(("", DROPPED))
    return out


def restore(word: str, speller: Speller) -> str:
    """The likeliest word behind a disguised one."""
    if UNDISGUISED.match(word):
        return word
    logs = speller.logs
    paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for char, run in groupby(word):
        after: dict[tuple[int, int], tuple[float, str]] = {}
        choices = options(char, len(list(run)))
        for (a, b), (score, text) in paths.items():
            for meant, cost in choices:
                x, y, total = a, b, score + cost
                for letter in meant:
                    c = code(letter)
                    total += logs[x, y, c]
                    x, y = y, c
                if (x, y) not in after or after[x, y][0] < total:
                    after[x, y] = (total, text + meant)
        paths = after
    return max((s + logs[a, b, 0], t) for (a, b), (s, t) in paths.items())[1]


def short(word: bytes) -> bool:
    return len(word) <= PIECE or (len(word) <= 4 * PIECE and not word.isascii() and len(word.decode()) <= PIECE)


def spelled_apart(found: list[bytes]) -> list[str]:
    """Words that are set letter by letter or in short pieces: runs of pieces, joined."""
    runs = (b"".join(run).decode() for apart, run in groupby(found, key=short) if apart)
    return [joined for joined in runs if len(joined) >= WHOLE]


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) > n)]


def plain(word: str) -> str:
    return word.strip(EDGES).strip("!")


def weight_of(word: str, judge: Judge) -> tuple[str, float] | None:
    """A word's most telling feature, of itself or of what it was before its disguise."""
    weights, best = judge.weights, None
    bare = plain(word)
    tried = [bare]
    core = word.strip(EDGES.replace("*", "").replace("#", ""))
    if STRANGE.search(core) and LETTER.search(core):
        tried.append(restore(core, judge.speller))
    for w in tried:
        for f in features(w):
            got = weights.get(f)
            if got is not None and (best is None or got > best[1]):
                best = (f, got)
    return best


def hidden_inside(joined: str, judge: Judge, longest: int) -> tuple[str, float] | None:
    """The most telling whole word inside letters that stood apart; none has more than `longest`."""
    word = restore(joined, judge.speller)
    inside = (word[s:e] for s in range(len(word)) for e in range(s + WHOLE, min(len(word), s + longest) + 1))
    return max(((w, judge.weights[w]) for w in inside if w in judge.weights), key=lambda x: x[1], default=None)


class Reader:
    """Sums of texts, with a bounded memory of words seen."""

    def __init__(self, judge: Judge):
        self.judge = judge
        self.longest = max(map(len, judge.weights), default=0)
        # words as bytes, joined pieces as text
        self.seen: dict[bytes | str, tuple[str, float] | None] = {}

    def telling(self, data: bytes) -> dict[str, float]:
        """The telling features of a text."""
        found = words(data)
        seen, out = self.seen, {}
        if len(seen) > CACHED:
            seen.clear()
        for w in set(found):
            if w not in seen:
                seen[w] = weight_of(w.decode().lower(), self.judge)
            if seen[w]:
                out[seen[w][0]] = seen[w][1]
        for joined in spelled_apart(found):
            joined = joined.lower()
            if joined not in seen:
                seen[joined] = hidden_inside(joined, self.judge, self.longest)
            if seen[joined]:
                out[seen[joined][0]] = seen[joined][1]
        return out

    def inputs(self, data: bytes) -> tuple[float, ...]:
        found = self.telling(data).values()
        most = max(found, default=0.0)
        return 1.0, most, most * most, sum(found)

    def score(self, data: bytes) -> float:
        height = sum(a * b for a, b in zip(self.judge.curve, self.inputs(data), strict=True))
        return float(1 / (1 + np.exp(-height)))


def spelling_counts(docs: DataFrame) -> np.ndarray:
    """How often each three symbols follow each other, over all texts."""
    table = np.full(256, 27, np.int64)
    table[:128] = [code(chr(i).lower()) if chr(i).isalpha() else 0 for i in range(128)]
    schema = pa.schema([("at", pa.int64()), ("c", pa.int64())])

    def run(batches):
        total = np.zeros(SYMBOLS**3, np.int64)
        for b in pieces(batches, 128):
            data = np.frombuffer(b"  " + b"  ".join(utf8(b["text"])) + b"  ", np.uint8)
            x = table[data]
            total += np.bincount((x[:-2] * SYMBOLS + x[1:-1]) * SYMBOLS + x[2:], minlength=SYMBOLS**3)
        some = np.flatnonzero(total)
        yield batch(schema, {"at": pa.array(some), "c": pa.array(total[some])})

    out = np.zeros(SYMBOLS**3)
    for r in docs.select(text_column().alias("text")).mapInArrow(run, "at long, c long").groupBy("at").agg(F.sum("c").alias("c")).collect():
        out[r["at"]] = r["c"]
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def shares(counts: np.ndarray) -> np.ndarray:
    counts = counts + 0.01
    return counts / counts.sum(axis=2, keepdims=True)


def make_speller(counts: np.ndarray, lexicon: dict[str, float]) -> Speller:
    """The corpus's characters and the telling words', half and half: words that the corpus
    rarely has must still be likelier than letters at random."""
    own = np.zeros_like(counts)
    for w in lexicon:
        codes = [0, 0, *(code(c) for c in w.rstrip("-")), *([] if w.endswith("-") else [0])]
        for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
            own[a, b, c] += 1
    return Speller(np.log(0.5 * shares(counts) + 0.5 * shares(own)))


def feature_counts(sample: DataFrame) -> DataFrame:
    """(feature, toxic, clean): the number of sampled documents of each label that have it."""
    schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def rows(counts):
        found = list(counts[0] | counts[1])
        return batch(schema, {"feature": found, "toxic": [counts[1][f] for f in found], "clean": [counts[0][f] for f in found]})

    def run(batches):
        counts = (Counter(), Counter())
        for b in pieces(batches):
            for data, toxic in zip(utf8(b["text"]), b["toxic"].to_pylist(), strict=True):
                own = {plain(w.decode().lower()) for w in set(words(data))}
                counts[toxic].update({f for w in own for f in features(w) if w})
                if len(counts[0]) + len(counts[1]) > 400_000:
                    yield rows(counts)
                    counts = (Counter(), Counter())
        yield rows(counts)

    counted = sample.mapInArrow(run, "feature string, toxic long, clean long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(x: np.ndarray, labels: np.ndarray) -> tuple[float, ...]:
    """Weights of a logistic curve, by Newton's method, slightly ridged."""
    beta, ridge = np.zeros(x.shape[1]), 1e-3 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, x.T @ (labels - p) - ridge @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def learn(docs: DataFrame, labels: DataFrame) -> Judge:
    sample = stored(labelled_sample(docs, labels, "toxic", fold(FOLDS) != HELD, LABELLED))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Judge(make_speller(np.zeros((SYMBOLS,) * 3), {}), {}, (-700.0, 0.0, 0.0, 0.0))
    weight = F.log((F.col("toxic") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(clean + 1.0))
    found = (
        feature_counts(sample)
        .withColumn("weight", weight)
        .where((F.col("toxic") >= max(LEAST_DOCUMENTS, LEAST_SHARE * toxic)) & (F.col("weight") >= LEAST_WEIGHT))
        .orderBy(F.desc("toxic"), "feature")
        .limit(FEATURES)
        .collect()
    )
    weights = {r["feature"]: r["weight"] for r in found}
    judge = Judge(make_speller(spelling_counts(docs), weights), weights, (0.0, 0.0, 0.0, 0.0))

    def run(batches):
        reader = Reader(judge)
        for b in pieces(batches):
            inputs = np.array([reader.inputs(x) for x in utf8(b["text"])])
            columns = [pa.array(inputs[:, i]) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*columns, b["toxic"]], ["one", "most", "square", "total", "toxic"])

    rows = sample.mapInArrow(run, "one double, most double, square double, total double, toxic int").toPandas()
    x, y = rows[["one", "most", "square", "total"]].to_numpy(), rows["toxic"].to_numpy(dtype=float)
    return judge._replace(curve=fit(x, y))


def score(docs: DataFrame, judge: Judge, column: str = "score") -> DataFrame:
    """`docs` and the score of each row's text; a column of that name is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(judge)
    kept = [c for c in docs.columns if c != column]
    frame = docs.select([F.col(f"`{c}`") for c in kept])

    def run(batches):
        reader = Reader(sent.value)
        for b in pieces(batches):
            scores = [reader.score(x) for x in utf8(b.column(kept.index("text")))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], [*kept, column])

    return frame.mapInArrow(run, frame.withColumn(column, F.lit(0.0)).schema)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    out = score(docs.select(F.col("doc_id").cast("long"), "text"), learn(docs, labels))
    held = F.coalesce(fold(FOLDS) == HELD, F.lit(True))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without the documents predicted toxic, all columns kept."""
    name = "score"
    while name in docs.columns:
        name += "_"
    kept = score(docs, learn(docs, labels), name).where(F.col(f"`{name}`") < THRESHOLD)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
