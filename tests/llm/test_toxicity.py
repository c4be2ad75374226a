import random
import zlib
from itertools import groupby, product

import numpy as np
import pytest

from devpulse.llm.toxicity import (
    Reader,
    code,
    features,
    learn,
    make_speller,
    options,
    plain,
    restore,
    scored,
    shares,
    without_toxic,
)

BAD = ["idiot", "moron", "stupid", "loser"]
GOOD = [a + b for a in ("ka", "mo", "ri", "su", "te", "lo") for b in ("na", "ver", "dil", "st", "rum", "pa", "cle")]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    rows = []
    for i in range(300):
        words, toxic = rng.choices(GOOD, k=rng.randint(5, 60)), int(i % 4 == 0)
        for _ in range(2 * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture
def labels(spark, texts):
    return spark.createDataFrame([(i, t, 9) for i, _, t in texts], "doc_id long, toxic int, text int")


@pytest.mark.parametrize(
    "written", ["1d10t", "m0r0n", "stuuupid", "i.d.i.o.t", "st*pid", "$tup1d", "looooser", "s t u p i d", "what a l o s e r ok"]
)
def test_disguised_words_are_found(frame, texts, labels, written):
    judge = learn(frame([(i, t) for i, t, _ in texts]), labels)
    reader = Reader(judge)
    assert reader.score(written.encode()) > 0.7
    assert reader.score(b"the b00k 1s k.a.n.a") < 0.3


def test_restoring_takes_the_likeliest_path():
    speller = make_speller(np.zeros((28, 28, 28)), {"lilac": 1.0})
    assert restore("1!1@c", speller) == "lilac"
    assert restore("l.i.l.a.c", speller) == "lilac"
    assert np.allclose(shares(np.zeros((28, 28, 28))).sum(axis=2), 1)


def test_held_out_documents(frame, texts, labels):
    docs = frame([(i, t) for i, t, _ in texts])
    truth = {i: t for i, _, t in texts}
    rows = scored(docs, labels).collect()
    assert len(rows) == len(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}


def test_held_out_labels_are_not_learned(spark, frame, texts, labels):
    docs = frame([(i, t) for i, t, _ in texts])
    turned = spark.createDataFrame(
        [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, _, t in texts], "doc_id long, toxic int"
    )
    assert sorted(map(str, scored(docs, labels).collect())) == sorted(map(str, scored(docs, turned).collect()))


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    rows = scored(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert without_toxic(odd, labels.limit(0)).count() == odd.count()
    assert scored(odd.limit(0), labels).count() == 0


@pytest.mark.parametrize(
    "written",
    ["i d i o t https://example.com/" + "a-long-path/" * 9, "Ж" * 30 + " s t u p i d", "iidiot", "sttupid", "st up id", "you mo ro n ok", "lo s er"],
)
def test_more_disguises_are_found(frame, texts, labels, written):
    reader = Reader(learn(frame([(i, t) for i, t, _ in texts]), labels))
    assert reader.score(written.encode()) > 0.7
    assert reader.score(b"it is as we do in my book of tall letters") < 0.3


def all_readings(word, speller):
    """Every path through the lattice of a word, with its score."""
    runs = [options(c, len(list(run))) for c, run in groupby(word)]
    for path in product(*runs):
        text = "".join(meant for meant, _ in path)
        symbols = [0, 0, *map(code, text), 0]
        score = sum(cost for _, cost in path)
        score += sum(speller.logs[a, b, c] for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False))
        yield score, text


def test_every_spelling_of_a_short_word(frame, texts, labels):
    """Replaced, doubled and separated letters in all combinations: the decoder's reading is the
    best of all readings, and a document is scored by what all readings of its words give."""
    judge = learn(frame([(i, t) for i, t, _ in texts]), labels)
    forms = [{"i": ["i", "1", "!", "ii"], "d": ["d", "d."], "o": ["o", "0", "*"], "t": ["t", "7", "tt"]}[c] for c in "idiot"]
    spellings = ["".join(x) for x in product(*forms)]
    assert len(spellings) == 4 * 2 * 4 * 3 * 3
    reader = Reader(judge)
    for written in spellings:
        readings = list(all_readings(written, judge.speller))
        best = max(score for score, _ in readings)
        got = restore(written, judge.speller)
        if written != "idiot":
            assert any(text == got and abs(score - best) < 1e-9 for score, text in readings)
        # the most telling feature of the word as it is and of its best reading
        known = [judge.weights[f] for w in (plain(written), got) for f in features(w) if f in judge.weights]
        assert max(reader.telling(f"the {written} kaver".encode()).values(), default=0.0) == max(known, default=0.0)
