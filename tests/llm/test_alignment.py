import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from devpulse.llm import alignment
from devpulse.llm.alignment import aligned_documents, byte_letters
from devpulse.llm.perfect import PerfectHash

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


class Slow:
    """The contract, text by text, by both tokenizers on whole texts."""

    def __init__(self):
        self.one = Tokenizer.from_file(PATHS[0])
        self.one.encode_special_tokens = True
        self.two = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])

    def groups(self, text):
        if not text:
            return None
        letters = byte_letters()
        found = self.one.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(letters[c] for c in self.one.id_to_token(i))) for i in found.ids]
        b = []
        for i in self.two.encode(text):
            piece = self.two.id_to_piece(i)
            byte = re.fullmatch("<0x(..)>", piece)
            b.append((i, bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()))
        want = (" " + text).encode()
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            return None
        ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (a, b)]
        common = sorted(ends[0] & ends[1])
        out = []
        for side in (a, b):
            groups, at, k = [[]], 0, 0
            for i, x in side:
                groups[-1].append(i)
                at += len(x)
                if at == common[k]:
                    groups.append([])
                    k += 1
            out.append(groups[:-1])
        return list(zip(*out, strict=True))

    def rows(self, texts):
        every = [(i, self.groups(t)) for i, t in texts]
        links = [[(x, y) for a, b in g or [] for x in a for y in b] for _, g in every]
        count = Counter(p for own in links for p in set(own))
        most = defaultdict(int)
        for (x, _), n in count.items():
            most[x] = max(most[x], n)
        rows = []
        for (i, g), own in zip(every, links, strict=True):
            text = None if g is None else ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            digest = "" if text is None else hashlib.sha256(text.encode()).hexdigest()
            sizes = [sum(len(x[k]) for x in g or []) for k in (0, 1)]
            best = sum(count[p] == most[p[0]] for p in own)
            rows.append((i, *sizes, len(g or []), len(own), best, sum(count[p] for p in own), digest))
        return sorted(rows, key=str)


@pytest.fixture(scope="module")
def slow():
    return Slow()


PARTS = ["hello", "World's", "naïve", "  ", " ", "\n", "\r\n", "x;\r", "\t", "\x1c", "\x85", "\xa0", "漢字仮名", "😀👍🏽", "123456", "<s>", "</s>",
         "<|endoftext|>", "<0x41>", "ﬁ", "Å", "á", " ", "　", "def f(x):\r\n", "aaaaaaaaaaaaaaaaaaaaaa", "\x00", "()\r", "'ll", "…", "Übergröße", "᠎"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    made = ["".join(rng.choice(PARTS) + rng.choice(("", " ", "  ")) for _ in range(rng.randint(1, 25))) for _ in range(300)]
    fixed = [None, "", " ", "\n", "one▁two", "one two", "one two", "word " * 3000, "x" * 5000, "=" * 3000, "漢" * 900, "\r", " \r ", "."]
    return list(enumerate(fixed + made))


@pytest.mark.parametrize("small", [False, True])
def test_rows_are_those_of_whole_texts(frame, slow, texts, monkeypatch, small):
    """Also with a join in place of a table that is sent, and with small parts of everything."""
    if small:
        for name, value in {"SENT_PAIRS": 0, "BUCKET": 50, "FAN": 2, "HELD": 200, "CACHED": 100, "BLOCK": 50, "LINKS": 7}.items():
            monkeypatch.setattr(alignment, name, value)
    alignment.Aligner._loaded.clear()
    docs = frame(texts).repartition(5)
    found = sorted((tuple(r) for r in aligned_documents(docs, *PATHS).collect()), key=str)
    assert found == slow.rows(texts)
    assert any(r[1] == 0 and texts[r[0]][1] for r in found)


def test_odd_rows(odd, slow):
    rows = aligned_documents(odd, *PATHS)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in rows.collect()), key=str) == slow.rows([(r.doc_id, r.text) for r in odd.collect()])
    assert aligned_documents(odd.limit(0), *PATHS).count() == 0


def test_hashes_are_perfect_and_minimal():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 1000, 50_000):
        keys = np.unique(rng.integers(0, 2**32, n))
        perfect = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
        assert sorted(perfect(keys).tolist()) == list(range(len(keys))) and perfect.size == len(keys)
        others = np.setdiff1d(rng.integers(0, 2**32, 500), keys)
        assert ((perfect(others) >= -1) & (perfect(others) < max(1, len(keys)))).all()


def test_a_vector_is_the_sum_of_its_parts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 2)
    rng = random.Random(2)
    rows = [(rng.randrange(40) << 16 | rng.randrange(9), rng.randint(1, 5)) for _ in range(900)]
    counts = alignment.stored(spark.createDataFrame(rows, "pair long, n long").repartition(11))
    hashed = alignment.hashes(counts, 3)
    got = {}
    for r in hashed.join(alignment.count_vectors(counts, hashed, 3), "bucket").collect():
        got.update(zip(np.frombuffer(r.pairs, np.int64).tolist(), np.frombuffer(r.counts, np.int64).tolist(), strict=True))
    want = Counter()
    for p, n in rows:
        want[p] += n
    assert got == want
