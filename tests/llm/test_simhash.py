import random

import numpy as np
import pytest
import xxhash

from devpulse.llm import simhash
from devpulse.llm.components import connected_components
from devpulse.llm.simhash import keep_one, near_duplicates, shingles, spanning


def slow_print(text):
    found = (text or "").encode().lower().split()
    own = shingles(found, 3)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in own]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def slow_components(prints):
    root = dict.fromkeys(prints)
    for k in sorted(prints):
        if root[k] is not None:
            continue
        root[k], todo = k, [k]
        while todo:
            a = todo.pop()
            for b in prints:
                if root[b] is None and bin(prints[a] ^ prints[b]).count("1") <= 3:
                    root[b] = k
                    todo.append(b)
    return root


@pytest.fixture
def family(frame):
    """Texts of a few words, so that many fingerprints are near, and copies of them."""
    rng = random.Random(3)
    base = [" ".join(rng.choices("alpha beta gamma delta epsilon zeta".split(), k=rng.randint(0, 60))) for _ in range(60)]
    texts = []
    for i in range(240):
        w = rng.choice(base).split()
        if w and i % 3:
            w[rng.randrange(len(w))] = "changed"
        texts.append((1000 - i, " ".join(w)))
    return frame(texts)


@pytest.mark.parametrize("most", [512, 2])
def test_classes_are_those_of_all_pairs(family, monkeypatch, most):
    monkeypatch.setattr(simhash, "GROUP", most)
    prints = {r.doc_id: slow_print(r.text) for r in family.collect()}
    root = slow_components(prints)
    for r in near_duplicates(family).collect():
        assert r.fingerprint == f"{prints[r.doc_id]:016x}"
        assert r.component_id == root[r.doc_id]


def test_spanning_connects_what_is_near():
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 2**9, 60).astype(np.uint64) << np.uint64(20)
    fps = np.unique(fps)
    links = spanning(fps, np.arange(len(fps)))
    assert len(links) < len(fps)
    assert all(bin(int(fps[a] ^ fps[b])).count("1") <= 3 for a, b in links)


def test_components_of_a_path(spark):
    edges = spark.range(1, 60).selectExpr("id as a", "id - 1 as b").union(spark.createDataFrame([(90, 80), (7, 7)], "a long, b long"))
    found = {r.node: r.root for r in connected_components(edges).collect()}
    assert found == {**dict.fromkeys(range(60), 0), 80: 80, 90: 80}


def test_keep_one_of_each_class(family):
    """The smallest id of each class of fingerprints, as all pairs give them; nothing else goes."""
    root = slow_components({r.doc_id: slow_print(r.text) for r in family.collect()})
    kept = keep_one(family).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(root.values()))
    assert len(kept) < len(root)


def test_odd_rows(odd):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].fingerprint == by_id[3].fingerprint == "0" * 16 and by_id[3].component_id == 2
    assert by_id[4].component_id == 1 and by_id[None].component_id is None
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "5", "6", "None"]
    assert keep_one(odd.limit(0)).count() == 0 and near_duplicates(odd.limit(0)).count() == 0


def test_keep_one_of_repeated_ids(frame):
    """A repeated id under different texts is a row each; a repeated row stays once."""
    rng = random.Random(4)
    one, two = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(300)) for _ in range(2))
    kept = keep_one(frame([(7, one), (7, two), (7, one), (9, two)])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(7, one), (7, two)])
