import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from devpulse.llm.packing import Chunks, binary_lengths, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "It's they're don't, I'LL.", "a\x1cb\x1d \x1f c", "<|endoftext|> x<|startoftext|>y", "naïve é  漢字 123,45 ...!!",
    " \t\n\r\x0b\x0c ", "ΑΣ ος İstanbul ﬁ ½ ²", "word. word, WORD.. ,word", "x" * 3000, "ñ.", "́ ́a",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_tokenizer_s(tokenizer):
    for _ in range(2):  # new chunks, and remembered ones
        for text, ids in zip(HARD, Chunks.of(PATH).ids(HARD, 2), strict=True):
            assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], text


def test_forgetting_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr("devpulse.llm.packing.CACHED", 3)
    chunks = Chunks(PATH)
    for text in HARD * 2:
        (ids,) = chunks.ids([text], 2)
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("n", [1, 2, 3, 1023, 4096, 4097, 12345])
def test_lengths_are_powers_of_two(n):
    got = binary_lengths(n)
    assert sum(got) == n and got == sorted(got, reverse=True)
    assert all(x & (x - 1) == 0 and x <= 4096 for x in got) and len(set(got) - {4096}) == len([x for x in got if x < 4096])


def test_pieces_make_up_the_documents(frame, odd, tokenizer):
    rows = [(i, t) for i, t in enumerate([*HARD, "some words " * 4000])]
    for docs in (frame(rows), odd):
        found = pack(docs, PATH).collect()
        assert len({r.sequence_id for r in found}) == len(found) and all(r.offset == 0 for r in found)
        whole = {}
        for r in sorted(found, key=lambda r: (r.sequence_id, r.start)):
            assert r.length == len(r.ids) == 1 << r.bucket
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            if r.start == 0:
                whole.setdefault(r.doc_id, []).append([])
            whole[r.doc_id][-1] += r.ids
            assert r.start + r.length == len(whole[r.doc_id][-1]) <= r.doc_tokens
        for d in docs.collect():
            ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]
            assert ids in whole[d.doc_id]
    assert pack(odd.limit(0), PATH).count() == 0
