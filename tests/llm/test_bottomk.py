import hashlib

import numpy as np

from devpulse.llm.bottomk import (
    K,
    WIDTH,
    compare_edited,
    containment,
    distinct,
    fingerprints,
    from_text,
    merge,
    merged,
    resemblance,
    shingle_hashes,
    sketch,
    to_text,
)


def windows(text):
    padded = "\0" * (WIDTH - 1) + text
    return {padded[i : i + WIDTH] for i in range(len(text))}


def made_up(seed, n=4000):
    return "".join(np.random.default_rng(seed).choice(list("abcdé😀"), n))


def test_equal_windows_have_equal_hashes():
    text = made_up(1, 300) * 2
    hashes = shingle_hashes(text)
    assert len(hashes) == len(text)
    assert len(set(hashes.tolist())) == len(windows(text))


def test_estimates():
    a, b = made_up(1), made_up(1)[:2000] + made_up(2)[:2000]
    sa, sb = sketch(a), sketch(b)
    wa, wb = windows(a), windows(b)
    assert abs(resemblance(sa, sb) - len(wa & wb) / len(wa | wb)) < 0.15
    assert abs(containment(sa, sb) - len(wa & wb) / len(wa)) < 0.2
    assert abs(distinct(sa) / len(wa) - 1) < 0.3
    assert distinct(sketch("abcdef")) == 6


def test_merging_is_the_sketch_of_the_union():
    x, y = shingle_hashes(made_up(1)), shingle_hashes(made_up(2))
    whole = np.unique(np.concatenate([x, y]))[:K]
    assert (merge(sketch(made_up(1)), sketch(made_up(2))) == whole).all()
    assert (from_text(to_text(whole)) == whole).all()


def test_merged_by_key(spark, frame):
    rows = [(i, made_up(i, 500)) for i in range(8)]
    made = fingerprints(frame(rows)).selectExpr("doc_id % 2 as part", "fingerprint")
    for r in merged(made, "part", salts=3).collect():
        want = np.array([], np.uint64)
        for i, t in rows:
            if i % 2 == r.part:
                want = merge(want, sketch(t))
        assert r.fingerprint == to_text(want)


def check(rows, found):
    def key(r):
        return (r[0] is not None, r[0] or 0)

    order = sorted(rows, key=lambda r: hashlib.sha256((r[1] or "").encode()).digest()[:8])
    order = [(i, t or "") for i, t in sorted(order, key=key, reverse=True)]
    want = []
    for at, (i, t) in enumerate(order):
        after = order[(at + 1) % len(order)][1]
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), resemblance(sketch(t), sketch(after))))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_next) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_neighbours_over_many_ranges(frame):
    rows = [(i * 37 % 101, made_up(i, i)) for i in range(101)]
    check(rows, compare_edited(frame(rows)).collect())


def test_one_document_is_its_own_neighbour(frame):
    (row,) = compare_edited(frame([(5, "abcdef")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and row.near_next == 1


def test_odd_rows(odd):
    rows = compare_edited(odd).collect()
    assert len(rows) == odd.count()
    by_text = {r.doc_id: r for r in rows}
    assert by_text[1].fingerprint == by_text[4].fingerprint
    assert by_text[2].fingerprint == by_text[3].fingerprint == "" and by_text[3].near_next == 1
    assert compare_edited(odd.limit(0)).count() == 0
