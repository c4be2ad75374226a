"""Scoring texts with a hidden Markov model of their words.

Tokens are words and one end.  The model's symbols are the `TOP` commonest words, the end, and
`CLASSES` classes of all other words by their last three bytes; a word of a class has its smoothed
share of the class, so the probabilities of all texts sum as they should.  Baum-Welch starts from
a bounded sample and then runs over the whole corpus, expected counts being summed by partition
and then by symbol.  The scaled forward recursion gives the exact probability of a text.

Counts cover every training token.  The `KNOWN` commonest words go to the tasks in a broadcast of
that bounded size; all others meet their counts in a join on their 64-bit hash (a chance of 1e-6
for one false match in six million words).

Null texts count as empty: the end alone.  Documents with a null id are held out.  Repeated rows
count and are scored each on their own.  Without training text the scores are those of unseen
words; an empty table gives no rows."""

from collections import Counter
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.llm.common import batch, fold, pieces, stored, text_column, utf8, words

STATES = 8
TOP = 16_384
KNOWN = 262_144
CLASSES = 512
FOLDS = 10
# documents that training starts from, the most tokens that one of these has (longer ones count
# from the first round over the corpus on), and the rounds there
SAMPLE, SAMPLE_TOKENS = 600, 10_000
SAMPLE_ROUNDS = 15
# rounds over the whole corpus: until one gains less than this, in log10 a token; at least and at most
SETTLED = 0.002
ROUNDS = (2, 4)
# words of a document that one training sequence holds
SEGMENT = 256
# weight, in tokens, of the corpus-wide shares in a state's own
PRIOR = 20.0
ADDED = 0.1


class Vocabulary(NamedTuple):
    """Known words by falling count, their counts, and totals over all training tokens."""

    known: list[bytes]
    counts: np.ndarray
    ends: int
    tokens: int
    distinct: int
    class_totals: np.ndarray  # log10 of the smoothed total of each class
    top: int  # how many words are symbols of their own

    @property
    def denominator(self) -> float:
        return float(np.log10(self.tokens + ADDED * (self.distinct + 1)))


class Model(NamedTuple):
    first: np.ndarray  # by state
    move: np.ndarray  # from state, to state
    emit: np.ndarray  # by symbol and state


def word_class(word: bytes, classes: int) -> int:
    return xxhash.xxh32_intdigest(word[-3:]) % classes


def word_key(word: bytes) -> int:
    """The word's hash as Spark's signed long."""
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def prepared(docs: DataFrame) -> DataFrame:
    held = F.coalesce(fold(FOLDS) == 0, F.lit(True))
    return docs.select(F.col("doc_id").cast("long"), text_column().alias("text"), held.alias("held_out"))


def count_words(training: DataFrame, classes: int = CLASSES) -> DataFrame:
    """(word, class, key, c): every distinct word of the training texts.  Tasks count first."""
    schema = pa.schema([("word", pa.binary()), ("class", pa.int32()), ("key", pa.int64()), ("c", pa.int64())])

    def rows(counts: Counter):
        found = list(counts)
        columns = {"word": found, "class": [word_class(w, classes) for w in found]}
        columns |= {"key": [word_key(w) for w in found], "c": list(counts.values())}
        return batch(schema, columns)

    def run(batches):
        counts: Counter = Counter()
        for b in pieces(batches):
            counts.update(chain.from_iterable(map(words, utf8(b["text"]))))
            if len(counts) > 300_000:
                yield rows(counts)
                counts = Counter()
        yield rows(counts)

    counted = training.select("text").mapInArrow(run, "word binary, class int, key long, c long")
    return counted.groupBy("word", "class", "key").agg(F.sum("c").alias("c"))


def commonest(counts: DataFrame, most: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, counts and classes of the commonest words, at most `most`: those above the least
    count that leaves no more, so that no task or driver has to order all of them."""
    held = stored(counts.groupBy("c").agg(F.count("*").alias("n")))
    above = lambda c: held.where(F.col("c") >= c).agg(F.sum("n")).first()[0] or 0
    low, least = 0, 1 + (held.agg(F.max("c")).first()[0] or 0)
    while least - low > 1:
        middle = (low + least) // 2
        low, least = (low, middle) if above(middle) <= most else (middle, least)
    found = counts.where(F.col("c") >= least).select("word", "c", "class").toArrow()
    named, c, classes = (found[n].combine_chunks() for n in ("word", "c", "class"))
    named, c, classes = named.to_pylist(), c.to_numpy(), classes.to_numpy()
    order = sorted(range(len(named)), key=lambda i: (-c[i], named[i]))
    return [named[i] for i in order], c[order].astype(np.int64), classes[order].astype(np.int64)


def learn_vocabulary(
    counts: DataFrame, documents: int, top: int = TOP, sent: int = KNOWN, classes: int = CLASSES
) -> Vocabulary:
    total = counts.agg(F.sum("c"), F.count("*")).first()
    known, c, class_of = commonest(counts, sent)
    sums = np.zeros((classes, 2))
    for r in counts.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        sums[r["class"]] = r["c"], r["v"]
    # the commonest words are symbols of their own
    own = c[:top]
    np.subtract.at(sums, class_of[:top], np.column_stack([own, np.ones(len(own))]))
    return Vocabulary(
        known,
        c,
        documents,
        int(total[0] or 0) + documents,
        total[1] + (documents > 0),
        np.log10(sums[:, 0] + ADDED * (sums[:, 1] + 1)),
        len(own),
    )


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, ids (symbols), known (tokens with a count that
    the broadcast words have), base (their logarithms), classed (logarithms of their and all
    rarer words' shares of their classes, but for the rarer words' counts), rare (keys)."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    fields = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64())]
    fields += [("ids", pa.list_(pa.int32())), ("known", pa.int64()), ("base", pa.float64())]
    schema = pa.schema([*fields, ("classed", pa.float64()), ("rare", pa.list_(pa.int64()))])

    def run(batches):
        v = sent.value
        top, classes = v.top, len(v.class_totals)
        place = {w: i for i, w in enumerate(v.known)}
        logs = np.log10(v.counts + ADDED)
        end = float(np.log10(v.ends + ADDED))
        class_of = np.array([word_class(w, classes) for w in v.known[top:]], np.int64)
        symbol = np.concatenate([np.arange(top), top + 1 + class_of]).astype(np.int32)
        # of words in classes: the logarithm of the share of the class
        share = logs.copy()
        share[:top] = 0
        share[top:] -= v.class_totals[class_of]
        for b in pieces(batches):
            rows: dict[str, list] = {n: [] for n in schema.names}
            for doc, held, data in zip(b["doc_id"].to_pylist(), b["held_out"].to_pylist(), utf8(b["text"]), strict=True):
                found = words(data)
                at = np.fromiter(map(place.get, found, repeat(-1)), np.int64, len(found))
                ids = np.empty(len(found) + 1, np.int32)
                ids[-1] = top
                unknown = np.flatnonzero(at < 0)
                inside = at[at >= 0]
                ids[:-1][at >= 0] = symbol[inside]
                rare = [found[i] for i in unknown]
                of_rare = np.array([word_class(w, classes) for w in rare], np.int64)
                ids[:-1][unknown] = top + 1 + of_rare
                rows["doc_id"].append(doc)
                rows["held_out"].append(held)
                rows["n_tokens"].append(len(ids))
                rows["ids"].append(ids)
                rows["known"].append(len(inside) + (v.ends > 0))
                rows["base"].append(float(logs[inside].sum()) + end)
                rows["classed"].append(float(share[inside].sum() - v.class_totals[of_rare].sum()))
                rows["rare"].append([word_key(w) for w in rare])
            yield batch(schema, rows)

    ddl = "doc_id long, held_out boolean, n_tokens long, ids array<int>, known long, base double, classed double, rare array<long>"
    return docs.mapInArrow(run, ddl)


def segments(ids: list[np.ndarray]) -> list[np.ndarray]:
    return [x[s : s + SEGMENT] for x in ids for s in range(0, len(x), SEGMENT)]


def expected_counts(parts: list[np.ndarray], model: Model) -> Model:
    """Expected counts over sequences, in a model's shape."""
    return expectations(parts, model)[0]


def expectations(parts: list[np.ndarray], model: Model) -> tuple[Model, float]:
    """Forward and backward over sequences side by side: expected counts, and log10 of the
    sequences' probability."""
    k, symbols = len(model.first), len(model.emit)
    first, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((symbols, k))
    likely = 0.0
    parts = sorted(parts, key=len, reverse=True)
    for start in range(0, len(parts), 512):
        group = parts[start : start + 512]
        lengths = np.array([len(x) for x in group])
        longest = int(lengths[0])
        ids = np.zeros((longest, len(group)), np.int64)
        for j, x in enumerate(group):
            ids[: len(x), j] = x
        live = [int((lengths > t).sum()) for t in range(longest)]
        seen = model.emit[ids]
        forward, scale = np.zeros_like(seen), np.ones((longest, len(group), 1))
        a = model.first * seen[0]
        for t in range(longest):
            n = live[t]
            if t:
                a = (a[:n] @ model.move) * seen[t, :n]
            s = a.sum(axis=1, keepdims=True)
            a = a / s
            forward[t, :n], scale[t, :n] = a, s
        likely += float(np.log10(scale).sum())
        backward = np.ones_like(seen)
        for t in range(longest - 2, -1, -1):
            n = live[t + 1]
            ahead = seen[t + 1, :n] * backward[t + 1, :n] / scale[t + 1, :n]
            backward[t, :n] = ahead @ model.move.T
            move += forward[t, :n].T @ ahead
        held = forward * backward
        alive = np.arange(longest)[:, None] < lengths
        first += held[0].sum(axis=0)
        flat, weight = ids[alive], held[alive]
        for j in range(k):
            emit[:, j] += np.bincount(flat, weight[:, j], symbols)
    return Model(first, move * model.move, emit), likely


def from_counts(counts: Model, shares: np.ndarray) -> Model:
    """The model that the counts ask for, smoothed: each state's symbols towards the corpus's."""
    first = counts.first + 1
    move = counts.move + 1
    emit = counts.emit + PRIOR * shares[:, None]
    return Model(first / first.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def corpus_shares(v: Vocabulary) -> np.ndarray:
    counts = np.concatenate([v.counts[: v.top], [v.ends], 10.0**v.class_totals])
    return (counts + ADDED) / (counts + ADDED).sum()


def from_sample(sample: list[np.ndarray], v: Vocabulary, states: int = STATES) -> Model:
    """A first model: clusters of whole documents by their symbols, then Baum-Welch on the sample."""
    shares, rng = corpus_shares(v), np.random.default_rng(7)
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95)
    emit = shares[:, None] * rng.gamma(1.0, size=(len(shares), states))
    model = Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0))
    if not sample:
        return model
    bags = [np.unique(x, return_counts=True) for x in sample]
    likely = rng.dirichlet(np.full(states, 0.1), len(bags))
    for _ in range(12):
        counts = np.zeros((len(shares), states))
        for (x, n), p in zip(bags, likely, strict=True):
            counts[x] += n[:, None] * p
        emit = from_counts(Model(model.first, model.move, counts), shares).emit
        logs = np.log(emit)
        prior = np.log(likely.mean(axis=0) + 1e-9)
        for i, (x, n) in enumerate(bags):
            score = prior + n @ logs[x]
            likely[i] = np.exp(score - score.max())
            likely[i] /= likely[i].sum()
    model = Model(model.first, move, emit)
    parts = segments(sample)
    for _ in range(SAMPLE_ROUNDS):
        model = from_counts(expected_counts(parts, model), shares)
    return model


def corpus_round(training: DataFrame, model: Model, shares: np.ndarray) -> tuple[Model, float]:
    """One round of Baum-Welch over all of `training` (ids): the next model, and log10 of the
    probability that `model` gives a token.  A task's counts come as a row per symbol and, after
    the symbols, per state (moves), one for the first states, and one for likelihood and tokens."""
    k, symbols = len(model.first), len(model.emit)
    sent = training.sparkSession.sparkContext.broadcast(model)
    names = [f"s{j}" for j in range(k)]
    schema = pa.schema([("row", pa.int64()), *((n, pa.float64()) for n in names)])

    def run(batches):
        total = np.zeros((symbols + k + 2, k))
        for b in pieces(batches, 2048):
            column = b["ids"]
            flat, at = column.values.to_numpy(), column.offsets.to_numpy()
            ids = [flat[s:e] for s, e in zip(at, at[1:], strict=False)]
            got, likely = expectations(segments(ids), sent.value)
            total[:-1] += np.vstack([got.emit, got.move, got.first])
            total[-1, :2] += likely, sum(map(len, ids))
        rows = np.flatnonzero(total.any(axis=1))
        columns = {n: pa.array(total[rows, j]) for j, n in enumerate(names)}
        yield batch(schema, {"row": pa.array(rows)} | columns)

    ddl = "row long, " + ", ".join(f"{n} double" for n in names)
    summed = training.select("ids").mapInArrow(run, ddl).groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
    found = summed.toPandas()
    total = np.zeros((symbols + k + 2, k))
    total[found["row"].to_numpy(dtype=np.int64)] = found[names].to_numpy()
    likely, tokens = total[-1, :2]
    new = Model(total[-2], total[symbols:-2], total[:symbols])
    return from_counts(new, shares), float(likely / max(1.0, tokens))


def forward(ids: list[np.ndarray], model: Model) -> np.ndarray:
    """log10 of the probability of each sequence: the exact forward recursion, scaled at each step."""
    order = sorted(range(len(ids)), key=lambda i: -len(ids[i]))
    lengths = np.array([len(ids[i]) for i in order])
    flat = np.concatenate([ids[i] for i in order]) if len(ids) else np.array([], np.int32)
    starts = np.cumsum(lengths) - lengths
    # how many sequences are longer than each step
    live = len(order) - np.cumsum(np.bincount(lengths, minlength=1))
    logs = np.zeros(len(order))
    a = None
    for t in range(int(lengths[0]) if len(order) else 0):
        n = live[t]
        seen = model.emit[flat[starts[:n] + t]]
        a = model.first * seen if a is None else (a[:n] @ model.move) * seen
        s = a.sum(axis=1)
        a = a / s[:, None]
        logs[:n] += np.log10(s)
    out = np.empty(len(order))
    out[order] = logs
    return out


def score(encoded: DataFrame, counts: DataFrame, vocabulary: Vocabulary, model: Model) -> DataFrame:
    """Scores of encoded documents: the forward recursion where they lie, and a join of their
    rarer words with the counts."""
    sent = encoded.sparkSession.sparkContext.broadcast(model)
    kept = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "classed"]

    def run(batches):
        for b in pieces(batches, 2048):
            column = b["ids"]
            flat, at = column.values.to_numpy(), column.offsets.to_numpy()
            logs = forward([flat[s:e] for s, e in zip(at, at[1:], strict=False)], sent.value)
            yield pa.RecordBatch.from_arrays([*(b[n] for n in kept), pa.array(logs)], [*kept, "logs"])

    ddl = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, classed double, logs double"
    scored = encoded.select(*kept, "ids").mapInArrow(run, ddl)
    rare = encoded.select("row", F.explode("rare").alias("key")).join(counts.select("key", "c"), "key", "left")
    c = F.coalesce("c", F.lit(0))
    sums = rare.groupBy("row").agg(
        F.sum(F.log10(c + F.lit(ADDED))).alias("rare_base"), F.count("c").alias("rare_known")
    )
    rare_base = F.coalesce("rare_base", F.lit(0.0))
    return scored.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rare_base - F.col("n_tokens") * F.lit(vocabulary.denominator)).alias("base_score"),
        (F.col("logs") + F.col("classed") + rare_base).alias("score"),
    )


def learn_and_score(
    docs: DataFrame, top: int = TOP, sent: int = KNOWN, classes: int = CLASSES
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = prepared(docs)
    training = docs.where("not held_out")
    counts = stored(count_words(training, classes))
    vocabulary = learn_vocabulary(counts, training.count(), top, sent, classes)
    encoded = stored(encode(docs, vocabulary).withColumn("row", F.monotonically_increasing_id()))
    learning = encoded.where("not held_out").select("ids", "row")
    # the rows are chosen by their numbers alone, so that no task gathers texts to choose from
    short = encoded.where(~F.col("held_out") & (F.col("n_tokens") <= SAMPLE_TOKENS))
    some = short.select("row").orderBy(F.xxhash64("row"), "row").limit(SAMPLE)
    some = learning.join(F.broadcast(some), "row").toArrow().sort_by("row")["ids"]
    model = from_sample([x.values.to_numpy() for x in some], vocabulary)
    before = -np.inf
    for done in range(ROUNDS[1]):
        new, likely = corpus_round(learning, model, corpus_shares(vocabulary))
        if done >= ROUNDS[0] and likely - before < SETTLED:
            break
        model, before = new, likely
    return score(encoded, counts, vocabulary, model)
