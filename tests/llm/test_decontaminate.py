import random

from devpulse.llm import decontaminate
from devpulse.llm.decontaminate import align, contaminated, without_leaks


def table(a, b):
    best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            turn = 2 if a[i - 1] == b[j - 1] else -1
            h[i][j] = max(0, h[i - 1][j - 1] + turn, h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_is_the_whole_table_s():
    rng = random.Random(4)
    for _ in range(1500):
        letters = [b"%d" % i for i in range(rng.randint(2, 8))]
        a, b = (rng.choices(letters, k=rng.randint(0, n)) for n in (12, 25))
        score, start, end = align(a, b)
        assert score == table(a, b)
        assert not score or table(a, b[start:end]) == score


def passages(spark, frame):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    items = [words(rng.randint(12, 40)) for _ in range(15)]
    docs = []
    for i in range(120):
        text, item = words(rng.randint(0, 150)), rng.choice(items)
        part = list(item)
        if i % 3 == 1:
            for at in rng.sample(range(len(part)), len(part) // 8):
                part[at] = "edited"
        if i % 3:
            at = rng.randint(0, len(text))
            text[at:at] = part
        docs.append((i, " ".join(text).replace("w7 ", "W7, ")))
    bench = spark.createDataFrame([(i, " ".join(w) + ".", 1.0) for i, w in enumerate(items)], "item_id long, text string, share double")
    return frame(docs), bench


def test_finds_what_aligning_everything_finds(spark, frame, monkeypatch):
    docs, bench = passages(spark, frame)
    items = {r.item_id: decontaminate.clean_words(r.text.encode()) for r in bench.collect()}
    want = {
        (d.doc_id, i)
        for d in docs.collect()
        for i, w in items.items()
        if table(w, decontaminate.clean_words(d.text.encode())) >= 0.5 * 2 * len(w)
    }
    for most in (200_000, 60):  # sent, and joined
        monkeypatch.setattr(decontaminate, "SENT_WORDS", most)
        assert {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()} == want
    assert len(want) >= 80
    left = {r.doc_id for r in without_leaks(docs, bench).collect()}
    assert left == set(range(120)) - {d for d, _ in want}


def test_odd_rows(spark, odd):
    bench = spark.createDataFrame(
        [(1, "The first text with some words, that follow each other in it"), (2, None), (3, ""), (4, "no")],
        "item_id long, text string",
    )
    assert sorted(r.doc_id for r in contaminated(odd, bench).collect()) == [1, 1, 4]
    left = without_leaks(odd, bench)
    assert left.columns == odd.columns and left.count() == odd.count() - 3
    assert contaminated(odd, bench.limit(0)).count() == 0 and contaminated(odd.limit(0), bench).count() == 0


def test_edits_all_along_an_item(spark, frame, monkeypatch):
    """Copies with every fifth or sixth word changed, the item's other words in other documents."""
    rng = random.Random(9)
    items = [[f"w{rng.randrange(400)}" for _ in range(42)] for _ in range(6)]
    docs = []
    for i, item in enumerate(items):
        for step in (5, 6):
            text = [f"x{rng.randrange(400)}" for _ in range(30)]
            text[10:10] = ["edited" if at % step == step - 1 else w for at, w in enumerate(item)]
            docs.append((10 * i + step, " ".join(text)))
        docs.append((10 * i, " ".join(item)))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    want = {(d, i) for d, t in docs for i, w in enumerate(items) if table(w, t.split()) >= 0.5 * 2 * len(w)}
    for most in (200_000, 0):
        monkeypatch.setattr(decontaminate, "SENT_WORDS", most)
        assert {(r.doc_id, r.item_id) for r in contaminated(frame(docs), bench).collect()} == want
    assert want >= {(10 * i + at, i) for i in range(6) for at in (0, 5, 6)}


def under_a_common_phrase(count):
    """Items that share three words and differ in all others."""
    return [{"item_id": i, "words": [b"what", b"is", b"the"] + [b"a%d_%d" % (i, k) for k in range(9)]} for i in range(count)]


def test_a_phrase_of_many_items_makes_no_pairs():
    """Thousands of items under one trigram seed what their other words make of it."""
    for count in (500, 8000):
        items = decontaminate.Items(under_a_common_phrase(count))
        held = {int(g): 1 for _, _, own in items.grams() for g in own}
        seeds = items.seeds(held, 10)
        assert max(len(places) for by_gram in seeds.values() for places in by_gram.values()) == 1
        assert all((i, 0) in seeds[4][int(decontaminate.grams(items.ids[i], 4)[0])] for i in range(0, count, 99))


def test_common_phrases_of_the_corpus(spark, frame, monkeypatch):
    """Trigrams that many documents hold count with the words behind them; copies are found in both
    ways, and a text of the common phrase alone is not one."""
    monkeypatch.setattr(decontaminate, "FEW", 3)
    rng = random.Random(3)
    item = "once upon a time there was " + " ".join(f"w{i}" for i in range(14))
    docs = [(i, "once upon a time " + " ".join(f"x{rng.randrange(999)}" for _ in range(30))) for i in range(40)]
    docs += [(100 + i, f"x{i} {item} y{i}") for i in range(3)] + [(200, item.replace("w3", "other"))]
    bench = spark.createDataFrame([(1, item), (2, "upon a time")], "item_id long, text string")
    for most in (200_000, 0):
        monkeypatch.setattr(decontaminate, "SENT_WORDS", most)
        found = {(r.doc_id, r.item_id) for r in contaminated(frame(docs), bench).collect()}
        assert {(100, 1), (101, 1), (102, 1), (200, 1)} <= found
        assert {d for d, i in found if i == 1} == {100, 101, 102, 200}
        # an item of three words is what all these documents hold
        assert {d for d, i in found if i == 2} == {d for d, _ in docs}
