"""Minimal perfect hashing of whole numbers: each of n known keys has a place of its own below n.

Keys are put into a bit array of `ROOM` bits a key; those that meet no other key there stay, the
rest go on to a next, smaller array under another hash.  A key's place is the number of bits set
before its own.  About four bits a key; a key that was not among those given gets any place, or
none, so whoever looks up compares with the key stored there."""

import numpy as np

ROOM = 2


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """64 bits of each key, others at each level."""
    x = keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for times in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(times)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """`levels` are bit arrays as 64-bit words, lowest bits first."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels, self.before, total = levels, [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.before.append(total + np.cumsum(ones) - ones)
            total += int(ones.sum())
        self.size = total

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        """Of distinct keys."""
        levels: list[np.ndarray] = []
        while len(keys):
            bits = -(-ROOM * len(keys) // 64) * 64
            at = (mixed(keys, len(levels)) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(at, minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            keys = keys[~alone[at]]
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; -1 for some that weren't given."""
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (words, before) in enumerate(zip(self.levels, self.before, strict=True)):
            if not len(left):
                break
            at = (mixed(keys[left], level) % np.uint64(64 * len(words))).astype(np.int64)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            found[left[hit]] = before[word[hit]] + np.bitwise_count(below)
            left = left[~hit]
        return found

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], np.int64)
        return sizes.tobytes() + b"".join(x.tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> "PerfectHash":
        count = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, count, 8)
        words = np.frombuffer(data, np.uint64, offset=8 * (count + 1))
        ends = np.cumsum(sizes)
        return cls([words[e - s : e] for s, e in zip(sizes, ends, strict=True)])
