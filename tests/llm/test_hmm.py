import itertools
import math
import zlib
from collections import Counter

import numpy as np

from devpulse.llm import hmm
from devpulse.llm.hmm import Model, expected_counts, forward, from_counts, learn_and_score


def random_model(rng, k=3, symbols=5):
    return Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(symbols), k).T)


def paths(ids, m):
    """Every path of states and its probability with the symbols."""
    k = len(m.first)
    for path in itertools.product(range(k), repeat=len(ids)):
        p = m.first[path[0]] * m.emit[ids[0], path[0]]
        for a, b, x in zip(path, path[1:], ids[1:], strict=False):
            p *= m.move[a, b] * m.emit[x, b]
        yield path, p


def test_forward_is_the_sum_over_paths():
    rng = np.random.default_rng(0)
    m = random_model(rng)
    some = [rng.integers(0, 5, n).astype(np.int32) for n in (4, 1, 6, 4)]
    want = [math.log10(sum(p for _, p in paths(x, m))) for x in some]
    assert np.allclose(forward(some, m), want)


def test_expected_counts_are_those_of_the_paths():
    rng = np.random.default_rng(1)
    m = random_model(rng)
    some = [rng.integers(0, 5, n) for n in (5, 2, 1, 3)]
    first, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for x in some:
        all_paths = list(paths(x, m))
        total = sum(p for _, p in all_paths)
        for path, p in all_paths:
            first[path[0]] += p / total
            for s, i in zip(path, x, strict=True):
                emit[i, s] += p / total
            for a, b in zip(path, path[1:], strict=False):
                move[a, b] += p / total
    got = expected_counts(some, m)
    assert np.allclose(got.first, first) and np.allclose(got.move, move) and np.allclose(got.emit, emit)


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(2)
    m, some = random_model(rng), [rng.integers(0, 5, 30) for _ in range(20)]
    before = forward(some, m).sum()
    after = forward(some, from_counts(expected_counts(some, m), np.full(5, 0.2))).sum()
    assert after > before


def slow(rows):
    held = {i: i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    counts = Counter(w for i, ws in tokens if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    base = lambda w: math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1)))
    return [(i, held[i], len(ws), sum(w in counts for w in ws), n, round(sum(map(base, ws)), 6)) for i, ws in tokens]


def same(rows, found):
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, slow(rows)))


def test_counts_and_base_scores(frame):
    # few words are symbols or sent, so that all ways of a word are taken
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, 40) % 60)) for i in range(40)]
    found = learn_and_score(frame(rows), top=5, sent=12, classes=4).collect()
    same(rows, found)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


def test_all_probabilities_of_a_word_sum_to_one(frame):
    """The symbols' probabilities, and each class's words with one unseen word."""
    docs = hmm.prepared(frame([(i, "a b c d e f g a b c a b") for i in range(1, 5)]))
    counts = hmm.count_words(docs.where("not held_out"), 4)
    v = hmm.learn_vocabulary(counts, docs.where("not held_out").count(), 3, 100, 4)
    assert np.isclose(hmm.from_sample([], v).emit.sum(axis=0), 1).all()
    for c in range(4):
        own = [r.c for r in counts.collect() if r["class"] == c and bytes(r.word) not in v.known[:3]]
        assert np.isclose(sum(x + 0.1 for x in own) + 0.1, 10 ** v.class_totals[c])


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    same(rows, learn_and_score(odd).collect())
    assert learn_and_score(odd.limit(0)).count() == 0


def test_nothing_to_learn_from(frame):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    (row,) = learn_and_score(frame([(held, "some words")])).collect()
    assert row.train_tokens == 0 and row.n_known == 0 and math.isfinite(row.score)
