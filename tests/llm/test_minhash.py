import random


import numpy as np
import pytest

from devpulse.llm import minhash
from devpulse.llm.minhash import near_duplicates, shingle_numbers


def shingle_set(text):
    found = (text or "").encode().lower().split()
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return set(zip(*(found[i:] for i in range(5)), strict=False))


def slow_components(texts):
    """Smallest id reachable over links of all pairs, by (id, text)."""
    sets = [shingle_set(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(texts):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return [(k, len(sets[i]), least.get(find(i))) for i, (k, _) in enumerate(texts)]


def edited(rng, words, n):
    new = list(words)
    for _ in range(n):
        at = rng.randrange(len(new))
        new[at : at + rng.choice((0, 1, 1))] = [f"x{rng.randrange(10**6)}"]
    return new


@pytest.fixture
def families():
    """Copies with few and many edits, so that many pairs are just above or below the threshold;
    short texts; a passage that many texts share; exact copies."""
    rng = random.Random(8)
    texts = []
    for family in range(10):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice((6, 40, 90, 300)))]
        for i in range(20):
            texts.append(edited(rng, base, rng.randrange(0, 1 + len(base) // 25)) if i else base)
    line = [f"line{i}" for i in range(60)]
    texts += [line + [f"o{rng.randrange(10**6)}" for _ in range(8)] for _ in range(60)]
    texts += [f"a b {i % 3}".split() for i in range(6)] + [["One"], ["oNE"], [], []]
    rng.shuffle(texts)
    return [(900 - 3 * i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("group", "block"), [(2048, 1024), (4, 3)])
def test_components_are_those_of_all_pairs(frame, families, monkeypatch, group, block):
    """Also where every group is large, so that longer runs and blocks decide."""
    monkeypatch.setattr(minhash, "GROUP", group)
    monkeypatch.setattr(minhash, "BLOCK", block)
    found = near_duplicates(frame(families)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(slow_components(families))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    sizes = [r.component_id for r in found]
    assert 20 < len(set(sizes)) < len(sizes) - 50


def test_odd_rows(odd):
    rows = near_duplicates(odd)
    assert rows.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = rows.collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[2].n_shingles == by_id[3].n_shingles == 0
    assert by_id[2].component_id == 2 and by_id[3].component_id == 3
    assert by_id[4].component_id == 1 and not by_id[4].kept
    assert by_id[6].n_shingles == 1
    assert by_id[None].component_id is None and by_id[None].kept
    assert near_duplicates(odd.limit(0)).count() == 0


def test_a_null_id_takes_the_others_component(frame):
    text = "one two three four five six seven"
    found = {r.doc_id: r for r in near_duplicates(frame([(None, text), (5, text), (None, "other words")])).collect() if r.n_shingles == 3}
    assert found[None].component_id == 5 and not found[None].kept and found[5].kept


def pair(rng, size, share):
    """Two sets of `size` numbers that share about `share` of their union."""
    both = round(size * 2 * share / (1 + share))
    pool = rng.integers(0, 2**63, 2 * size - both).astype(np.uint64)
    return np.unique(pool[:size]), np.unique(np.concatenate([pool[:both], pool[size:]]))


def test_estimates_are_unbiased():
    rng = np.random.default_rng(4)
    for share in (0.3, 0.6, 0.85):
        errors = []
        for _ in range(200):
            one, two = pair(rng, 100, share)
            real = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
            a, b = (np.frombuffer(minhash.packed(minhash.minima(x)), np.uint8).reshape(minhash.BITS, -1) for x in (one, two))
            differ = np.bitwise_count(np.bitwise_or.reduce(a ^ b)).sum()
            errors.append(minhash.estimate(minhash.HASHES - int(differ)) - real)
        assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06


@pytest.mark.parametrize("tier", [0, 1])
def test_bands_find_pairs_at_the_threshold(tier):
    rng = np.random.default_rng(5)
    index = minhash.runs(*minhash.TIERS[tier])
    for _ in range(400):
        one, two = pair(rng, int(rng.integers(40, 300)), 0.86)
        keys = [minhash.band_keys(minhash.minima(x), index) for x in (one, two)]
        assert (keys[0] == keys[1]).any()


def test_sketches_bound_what_is_not_shared():
    """No link between sets above the threshold is ruled out, whatever their widths."""
    rng = np.random.default_rng(6)
    for _ in range(300):
        one, two = pair(rng, int(rng.choice((20, 60, 64, 65, 250, 1000))), 0.87)
        two = np.union1d(two, rng.integers(0, 2**63, 2).astype(np.uint64)) if len(two) > 100 else two
        both = len(np.intersect1d(one, two))
        if 100 * both < 85 * (len(one) + len(two) - both):
            continue
        bits, odd = ([f(x) for x in (one, two)] for f in (lambda p: minhash.packed(minhash.minima(p)), minhash.parity))
        group = minhash.Group(np.arange(2), np.arange(2), np.array([len(one), len(two)]), bits, odd)
        assert list(group.every()) and list(group.spanning())


def test_shingles_are_distinct_and_lower_case():
    assert len(shingle_numbers(b"a b c d e a b c d e f".split())) == 6
    assert minhash.LEAST / minhash.HASHES > 0.75


@pytest.mark.parametrize("most", [1 << 20, 300])
def test_a_group_never_gives_more_links_than_it_has_nodes(frame, monkeypatch, most):
    """Copies that differ in one word each: any two share 113 of 133 shingles, just too few, and
    about half of all pairs look as if they shared enough.  Some are linked.  Also in blocks."""
    monkeypatch.setattr(minhash, "SHINGLES", most, raising=False)
    base = [f"w{i}" for i in range(127)]
    texts = [[*base[:at], f"x{at}-{k}", *base[at + 1 :]] for at in range(4, 123, 5) for k in range(1 + (at % 20 == 4))]
    docs = [(3 * i, " ".join(t)) for i, t in enumerate(texts)]
    more, links = [], minhash.grouped_links

    def note(groups, *args):
        groups = minhash.stored(groups)
        found = minhash.stored(links(groups, *args))
        sizes = groups.selectExpr("key", "size(members) AS n").join(found.groupBy("key").count(), "key")
        more.append(sizes.where("count >= n").count())
        return found

    monkeypatch.setattr(minhash, "grouped_links", note)
    found = near_duplicates(frame(docs)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(slow_components(docs))
    assert len({r.component_id for r in found}) == 24 < len(found)
    assert len(more) > 1 and not any(more)
