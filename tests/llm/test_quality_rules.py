import random
import zlib

import numpy as np

from devpulse.llm.quality import MEASURES, Rule, learn, measured, measures, paths, scored


def made(spark, frame):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(300):
        w = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(rng.randint(5, 80))]
        good = i % 3 != 0
        text = " ".join(w) + "." if good else rng.choice([" ".join(w).upper() + "!!", " | ".join(w), " ".join([w[0]] * 40)])
        docs.append((i, text))
        labels.append((i, int(good)))
    return frame(docs), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_documents(spark, frame):
    docs, labels = made(spark, frame)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = scored(docs, labels).collect()
    assert len(rows) == 300
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows if r.held_out]) > 0.95


def test_the_column_is_the_sum_of_the_rules(spark, frame):
    docs, labels = made(spark, frame)
    model = learn(docs, labels)
    assert 0 < len(model.rules) < 100
    rows = measured(docs, ("doc_id",)).withColumn("score", model.column()).collect()
    for r in rows[:50]:
        height = model.level + sum(
            w for rule, w in model.rules if all((r[m] <= t) == least for m, least, t in rule.terms)
        )
        assert np.isclose(r.score, 1 / (1 + np.exp(-height)))


def test_paths_of_a_printed_tree():
    printed = """Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 2 <= 0.25)
      Predict: 0.0
     Else (feature 2 > 0.25)
      Predict: 1.0
    Else (feature 0 > 1.5)
     Predict: 1.0"""
    a, b = (MEASURES[0], True, 1.5), (MEASURES[2], True, 0.25)
    c, d = (MEASURES[2], False, 0.25), (MEASURES[0], False, 1.5)
    assert paths(printed) == {Rule(tuple(sorted(x))) for x in ([a], [a, b], [a, c], [d])}


def test_measures():
    got = dict(zip(MEASURES, measures(b"AB ab! | x\nx x\nx x\n"), strict=True))
    assert got["n_words"] == 8 and got["distinct"] == 4 / 8 and got["lines"] == 3
    assert np.isclose(got["line_repeats"], 1 / 3) and np.isclose(got["upper"], 2 / 19)


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (4, None)], "doc_id long, quality int")
    rows = scored(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 for r in scored(odd, labels.limit(0)).collect())
    assert scored(odd.limit(0), labels).count() == 0
