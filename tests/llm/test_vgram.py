import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from devpulse.llm import vgram
from devpulse.llm.vgram import Dictionary, spelling_variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow(texts):
    """The contract's rows, by comparing all words."""
    total = Counter()
    for doc, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            total[low] += 1
    words = {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}
    near = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 10 * words[w]:
            form[w] = best
    rows = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(rows, key=str)


SYLLABLES = "tion ing ment able ción ado est thr lo que mi ñe".split()


@pytest.fixture
def texts():
    """Words of a few syllables, frequent and rare, with edits anywhere in them."""
    rng = random.Random(6)
    base = ["".join(rng.choices(SYLLABLES, k=rng.randint(2, 5))) for _ in range(120)]
    letters, texts = "abtionç", []
    for doc in range(60):
        words = []
        for _ in range(120):
            w = base[min(int(rng.expovariate(0.05)), 119)]
            if rng.random() < 0.2:
                at = rng.randrange(len(w) + 1)
                w = w[:at] + rng.choice(letters) * rng.randint(0, 1) + w[at + rng.randint(0, 1) :]
            words.append(w.title() if rng.random() < 0.1 else w)
        texts.append((doc, " 3,".join(words)))
    return texts


@pytest.mark.parametrize("parts", [20_000, 60, 2])
def test_rows_are_those_of_all_pairs(frame, texts, monkeypatch, parts):
    """With few and with many grams in the dictionary."""
    monkeypatch.setattr(vgram, "PARTS", parts)
    found = sorted((tuple(r) for r in spelling_variants(frame(texts)).collect()), key=str)
    assert found == slow(texts)
    assert len(found) > 200 and any(r[1] for r in found) and max(r[4] for r in found) > 3


def learned(words, parts):
    """A dictionary without Spark."""
    cut = [m for _, m in vgram.matrices(words)]
    counts = {q: Counter(np.concatenate([vgram.codes(m, q).ravel() for m in cut]).tolist()) for q in (2, 3, 4)}
    total = sum(counts[2].values())
    rows, before = [(c, 2, n) for c, n in counts[2].items()], set(counts[2])
    for q in (3, 4):
        level = {c for c in counts[q] if c >> 7 in before and counts[q - 1][c >> 7] * parts > total}
        rows += [(c, q, counts[q][c]) for c in level]
        before = level
    return Dictionary(rows)


def grams(dictionary, word):
    ((_, symbols),) = vgram.matrices([word])
    length, kept = dictionary.cut(symbols)
    places = np.flatnonzero(kept[0])
    text = f"^{word}$"
    return Counter(text[p : p + length[0, p]] for p in places), int(dictionary.bounds(symbols, length, kept)[0])


@pytest.mark.parametrize("parts", [20_000, 200, 40, 5])
def test_no_edit_changes_more_grams_than_the_bound(parts):
    """And every word keeps a gram at least."""
    rng = random.Random(7)
    words = sorted({"".join(rng.choices(SYLLABLES, k=rng.randint(2, 4)))[: rng.randint(7, 14)] for _ in range(300)})
    words = [w for w in words if len(w) >= 7]
    extra = [w[:i] + c + w[i + d :] for w in words for i, c, d in [(rng.randrange(len(w)), rng.choice("tnoia"), rng.randint(0, 1))]]
    dictionary = learned(words + extra, parts)
    for w in words[:120]:
        own, bound = grams(dictionary, w)
        assert sum(own.values()) - bound >= 1
        for i in range(len(w) + 1):
            for new in {w[:i] + "t" + w[i:], w[:i] + w[i + 1 :], w[:i] + "n" + w[i + 1 :]}:
                cut = [new[k : k + 2] for k in range(len(new) - 1)]
                if new != w and cut:
                    other = decomposed(dictionary, new)
                    assert sum((own - other).values()) <= bound


def decomposed(dictionary, word):
    ((_, symbols),) = vgram.matrices([word])
    length, kept = dictionary.cut(symbols)
    text = f"^{word}$"
    return Counter(text[p : p + length[0, p]] for p in np.flatnonzero(kept[0]))


def test_odd_rows(odd, frame):
    found = {r.word: r for r in spelling_variants(odd).collect()}
    want = slow([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted((tuple(r) for r in found.values()), key=str) == want
    assert spelling_variants(odd.limit(0)).count() == 0
    long = "abcdefghij" * 2000
    rows = [(1, long), (2, long), (3, long[:-1]), (4, long[:-1]), (5, "x" + long), (6, "x" + long)]
    got = {(len(r.word), r.n, r.n_near) for r in spelling_variants(frame(rows)).collect()}
    assert got == {(len(w), n, k) for w, _, _, n, k, _ in slow(rows)}


def test_runs_are_maximal_and_in_lower_case():
    assert vgram.runs("Ångström2ABCDEFGé×÷straße", 1, 7) == Counter({"Ångström".replace("A", "a"): 1, "abcdefgé×÷straße": 1})


def test_list_entries_are_not_written(frame, texts, monkeypatch):
    """They go from the words into one shuffle a role."""
    written = []

    def note(df):
        written.append(set(df.columns))
        return stored(df)

    stored = vgram.stored
    monkeypatch.setattr(vgram, "stored", note)
    words = stored(vgram.words_of(frame(texts)))
    pairs = vgram.near_pairs(words, Dictionary.learn(words))
    assert pairs.count() > 0
    assert written and not [columns for columns in written if "key" in columns]


def test_one_key_where_a_half_is_a_sentinel():
    """The last gram of a word has nothing but a sentinel or a letter and one to its right."""
    words = sorted({"".join(x) for x in itertools.product(["tion", "ment", "ado"], repeat=3)})
    extra = [w[:-1] for w in words] + [w[1:] for w in words] + [w[:-1] + "n" + w[-1] for w in words]
    words = sorted({*words, *extra})
    dictionary = learned(words, 20_000)
    keys = {0: {}, 1: {}, 2: {}}
    count = 0
    for rows, symbols in vgram.matrices(words):
        row, p, q, _ = dictionary.chosen(symbols)
        n = symbols.shape[1]
        for more in (0, 1):
            for whole in (n - p - q - more, p - more):
                count += int(np.minimum(np.maximum(whole, 0), 1).sum() + (whole > 2).sum())
        for role, row, key in vgram.list_entries(dictionary, symbols):
            for r, k in zip(row, key, strict=True):
                keys[role].setdefault(words[rows[r]], []).append(k)
    assert sum(len(k) for role in (1, 2) for k in keys[role].values()) == count
    for a, b in itertools.permutations(words, 2):
        if len(a) + 1 == len(b) and one_edit(a, b):
            assert set(keys[1][a]) & set(keys[2][b])
