"""Quality of whole texts by a sparse ensemble of rules.

Each text is measured once.  Shallow trees over the measures propose rules, the paths from their
roots; a logistic regression under an L1 penalty keeps few of them, and what it keeps becomes one
Spark column expression over the measures.

Trees and weights are learned with Spark's own library from at most `LABELLED` labelled documents
(those of smallest id hash) outside the held-out fold.  Null texts count as empty and have zero
for every measure; null ids are held out; labels that contradict count as 1; without labels of
both kinds the score is the share of label 1, or 0 without any.  An empty table gives no rows."""

import re
from collections import Counter
from functools import reduce
from operator import and_, eq
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.llm.common import fold, labelled_sample, pieces, stored, text_column, utf8

FOLDS, HELD = 5, 0
THRESHOLD = 0.3
LABELLED = 20_000
TREES, DEPTH = 16, 3
PENALTY = 0.002

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
BLANKS = b" \t\n\x0b\x0c\r"
MARKS = b".,;:!?'\"()-"
SIGNS = b"#$%&*+/<=>@[\\]^_`{|}~"
BEYOND = bytes(range(128, 256))
MEASURES = (
    "n_bytes", "n_words", "word_length", "upper", "digits", "blanks", "marks", "signs", "beyond", "loud",
    "bars", "distinct", "commonest", "repeated", "single", "lines", "line_length", "line_repeats", "line_ends",
)


class Rule(NamedTuple):
    """A conjunction: (measure, whether at most, bound) each."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        return reduce(and_, [F.col(m) <= F.lit(t) if least else F.col(m) > F.lit(t) for m, least, t in self.terms])


class Ensemble(NamedTuple):
    level: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        """The score, 0 to 1."""
        parts = [F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(lambda a, b: a + b, parts, F.lit(self.level))))


def measures(data: bytes) -> tuple[float, ...]:
    n = len(data)
    found = data.lower().split()
    if not found:
        return (float(n), *[0.0] * (len(MEASURES) - 1))
    share = lambda some: (n - len(data.translate(None, some))) / n
    k = len(found)
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        float(n),
        float(k),
        sum(map(len, found)) / k,
        share(UPPER),
        share(DIGITS),
        share(BLANKS),
        share(MARKS),
        share(SIGNS),
        share(BEYOND),
        data.count(b"!") / n,
        data.count(b"|") / n,
        len(set(found)) / k,
        Counter(found).most_common(1)[0][1] / k,
        sum(map(eq, found, found[1:])) / k,
        sum(len(w) == 1 for w in found) / k,
        float(len(lines)),
        k / len(lines),
        1 - len(set(lines)) / len(lines),
        sum(x.rstrip().endswith((b".", b"!", b"?", b":")) for x in lines) / len(lines),
    )


def measured(docs: DataFrame, kept: tuple[str, ...]) -> DataFrame:
    """The columns `kept` and the measures of `text`."""
    frame = docs.select(*kept, text_column().alias("text"))

    def run(batches):
        for b in pieces(batches):
            rows = [measures(x) for x in utf8(b["text"])]
            columns = [pa.array([r[i] for r in rows], pa.float64()) for i in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), *columns], [*kept, *MEASURES])

    schema = frame.drop("text").withColumns({m: F.lit(0.0) for m in MEASURES}).schema
    return frame.mapInArrow(run, schema)


def paths(description: str) -> set[Rule]:
    """The rules of trees as Spark prints them: every path from a root to a node below it."""
    out: set[Rule] = set()
    above: list[tuple[int, tuple[str, bool, float]]] = []
    for line in description.splitlines():
        test = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not test:
            continue
        depth = len(test[1])
        above = [x for x in above if x[0] < depth]
        above.append((depth, (MEASURES[int(test[2])], test[3] == "<=", float(test[4]))))
        out.add(Rule(tuple(sorted(x[1] for x in above))))
    return out


def learn(docs: DataFrame, labels: DataFrame) -> Ensemble:
    sample = labelled_sample(docs, labels, "quality", fold(FOLDS) != HELD, LABELLED)
    sample = stored(measured(sample, ("quality",)))
    sizes = {r["quality"]: r["count"] for r in sample.groupBy("quality").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Ensemble(40.0 if sizes.get(1) else -800.0, ())
    parts = VectorAssembler(inputCols=list(MEASURES), outputCol="measures")
    forest = RandomForestClassifier(
        labelCol="quality", featuresCol="measures", numTrees=TREES, maxDepth=DEPTH, seed=7
    )
    trees = forest.fit(parts.transform(sample))
    rules = sorted(paths(trees.toDebugString))
    names = [f"rule{i}" for i in range(len(rules))]
    held = [r.column().cast("double").alias(n) for r, n in zip(rules, names, strict=True)]
    held = VectorAssembler(inputCols=names, outputCol="rules").transform(sample.select("quality", *held))
    lasso = LogisticRegression(
        labelCol="quality", featuresCol="rules", elasticNetParam=1.0, regParam=PENALTY, maxIter=100
    ).fit(held.select("quality", "rules"))
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w]
    return Ensemble(float(lasso.intercept), tuple(kept))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    score = learn(docs, labels).column()
    held = F.coalesce(fold(FOLDS) == HELD, F.lit(True)).alias("held_out")
    out = measured(docs.select(F.col("doc_id").cast("long"), "text"), ("doc_id",))
    out = out.select("doc_id", held, score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
