"""b-bit MinHash near-duplicates.

A document's set is its distinct shingles of `SHINGLE` words.  Documents of equal sets are one
node.  A node keeps the `BITS` low bits of each of `HASHES` minima, packed; runs of whole minima
give band keys, and nodes that share a key are candidates.  The bits that two packed signatures
have in common, less what chance would give, estimate their similarity; what the estimate leaves
is confirmed on the full sets.

Candidates are never listed as all pairs of a group.  Groups of equal members are one.  A group is
walked in one task, which answers with a link for each node it can reach; a group of which a link
is not confirmed is walked once more with the full sets beside its nodes, from part to part of what
the confirmed links leave, so that each link it answers with is there.  A parity
sketch of each set, whose differing bits are never more than the elements that two sets do not
share, rules out nearly all pairs below the threshold before a text moves.  Groups of more than
`GROUP` nodes are indexed again under longer runs of minima, and at last in blocks.

Two documents at the threshold itself share no band key with a probability of about 3e-6 and are
estimated below `LEAST` with less than 1e-6; nothing else is left to chance."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.llm.common import batch, pieces, sent, stored, text_column, utf8, words
from devpulse.llm.components import connected_components
from devpulse.sources.sinks import in_scope

SHINGLE = 5
# linked: PERCENT of the union is shared, at least
PERCENT = 85
HASHES = 256
BITS = 2
# (minima a band, bands); the second for nodes in groups of more than GROUP
TIERS = ((8, 48), (16, 256))
GROUP = 2048
# nodes of a block of a group that is large even under the longest runs
BLOCK = 1024
# shingles of a group that is walked with full sets; more are walked in blocks
SHINGLES = 1 << 20
# bits of a parity sketch: twice the set's size at least, within these
PARITY = (1 << 8, 1 << 15)

_rng = np.random.default_rng(20)
# one number of a shingle's word hashes, the hash functions of the minima, and one of a run's minima
TURNS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 2**64) for i in range(SHINGLE)], np.uint64)
TIMES = _rng.integers(0, 2**31, HASHES).astype(np.uint32) * np.uint32(2) + np.uint32(1)
MIX = _rng.integers(0, 2**63, 64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def runs(rows: int, bands: int) -> np.ndarray:
    """Which minima each band takes: cuts of as many shuffles of all as are needed."""
    each, rng = HASHES // rows, np.random.default_rng(rows)
    cuts = [rng.permutation(HASHES)[: each * rows].reshape(each, rows) for _ in range(-(-bands // each))]
    return np.concatenate(cuts)[:bands]


def least_matches(share: float = PERCENT / 100, miss: float = 1e-6) -> int:
    """The fewest equal b-bit minima that two sets sharing `share` have but for `miss`."""
    p = share + (1 - share) / 2**BITS
    at, total = p**HASHES, 0.0
    chances = [at]
    for k in range(HASHES, 0, -1):
        at *= k / (HASHES - k + 1) * (1 - p) / p
        chances.append(at)
    for k, c in enumerate(reversed(chances)):
        total += c
        if total > miss:
            return k
    return HASHES


LEAST = least_matches()


def shingle_numbers(found: list[bytes]) -> np.ndarray:
    """The distinct shingles of the words as sorted 64-bit numbers; of fewer words the whole
    sequence, of none nothing."""
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found))], np.uint64)
    own = np.array(list(map(xxhash.xxh64_intdigest, found)), np.uint64)
    count = len(own) - SHINGLE + 1
    return np.unique(sum(own[i : i + count] * TURNS[i] for i in range(SHINGLE)))


def minima(parts: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that isn't empty."""
    low, least = parts.astype(np.uint32), np.full(HASHES, 2**32 - 1, np.uint32)
    for s in range(0, len(low), 256):
        np.minimum(least, (low[s : s + 256, None] * TIMES).min(axis=0), out=least)
    return least


def packed(least: np.ndarray) -> bytes:
    """The low bits of each minimum, lowest bits of all first."""
    mixed = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return b"".join(np.packbits((mixed >> np.uint32(i)) & np.uint32(1)).tobytes() for i in range(BITS))


def band_keys(least: np.ndarray, index: np.ndarray) -> np.ndarray:
    """A number for each band; bands have numbers of their own."""
    total = (least[index].astype(np.uint64) * MIX[: index.shape[1]]).sum(axis=1)
    total += np.arange(len(index), dtype=np.uint64) * MIX[-1]
    return ((total ^ (total >> np.uint64(32))) * MIX[-2]).view(np.int64)


def parity(parts: np.ndarray) -> bytes:
    """A bit for each place that an odd number of the set's elements fall on."""
    size = min(max(1 << (2 * len(parts) - 1).bit_length(), PARITY[0]), PARITY[1])
    places = ((parts >> np.uint64(32)) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=size) & 1).tobytes()


def estimate(matches: np.ndarray) -> np.ndarray:
    """Similarity from the number of equal b-bit minima, less those equal by chance."""
    chance = 1 / 2**BITS
    return (matches / HASHES - chance) / (1 - chance)


class Group:
    """Nodes that share a key, side by side: their roots, set sizes, signatures and sketches, and
    their full sets if they are to be compared by those too."""

    def __init__(self, node, root, size, bits: list[bytes], odd: list[bytes], sets: list[bytes] | None = None):
        self.sets = None
        if sets is not None:
            # shingles as numbers from 0, and where each node's begin
            number = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)[1]
            self.sets = np.split(number, np.cumsum([len(x) // 8 for x in sets])[:-1])
            self.marked = np.zeros(len(number), bool)
        self.node, self.root, self.size = node, root, size.astype(np.int64)
        self.bits = np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), BITS, -1)
        self.wide = np.array([len(x) for x in odd])
        # sketches by width, each also folded to half of it
        self.sketches, self.at = {}, np.zeros((2, len(odd)), np.int64)
        rows: dict[int, list[bytes]] = {}
        for i, x in enumerate(odd):
            half = np.frombuffer(x, np.uint8).reshape(2, -1)
            for f, data in enumerate((x, (half[0] ^ half[1]).tobytes())):
                self.at[f, i] = len(rows.setdefault(len(data), []))
                rows[len(data)].append(data)
        for width, data in rows.items():
            self.sketches[width] = np.frombuffer(b"".join(data), np.uint64).reshape(len(data), -1)

    def near(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of `others` that sizes, signatures and sketches allow a link with `i`."""
        a, b = self.size[i], self.size[others]
        others = others[100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)]
        differ = np.bitwise_or.reduce(self.bits[others] ^ self.bits[i], axis=1)
        matches = HASHES - np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
        others = others[matches >= LEAST]
        # elements that two sets don't share are at most this part of both
        most = (100 - PERCENT) * (self.size[others] + a)
        apart = np.zeros(len(others), np.int64)
        for width in np.unique(self.wide[others]).tolist():
            some = np.flatnonzero(self.wide[others] == width)
            shared = min(width, int(self.wide[i]))
            if shared not in self.sketches or max(width, self.wide[i]) > 2 * shared:
                continue
            own = self.sketches[shared][self.at[int(self.wide[i] > shared), i]]
            them = self.sketches[shared][self.at[int(width > shared), others[some]]]
            apart[some] = np.bitwise_count(them ^ own).sum(axis=1, dtype=np.int64)
        others = others[(100 + PERCENT) * apart <= most]
        return others if self.sets is None or not len(others) else self.linked(i, others)

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of `others` whose full sets share PERCENT of the union with that of `i`."""
        own, them = self.sets[i], [self.sets[j] for j in others.tolist()]
        self.marked[own] = True
        sizes = np.array([len(x) for x in them])
        both = np.add.reduceat(self.marked[np.concatenate(them)], np.cumsum(sizes) - sizes, dtype=np.int64)
        self.marked[own] = False
        return others[100 * both >= PERCENT * (len(own) + sizes - both)]

    def spanning(self) -> Iterator[tuple[int, int]]:
        """A link for each further component that the walk from one component to others reaches."""
        _, kind = np.unique(self.root, return_inverse=True)
        left = np.arange(len(kind))
        order = np.argsort(-np.bincount(kind), kind="stable").tolist()
        while len(left) and order:
            todo = left[kind[left] == order.pop(0)].tolist()
            left = np.setdiff1d(left, todo, assume_unique=True)
            while todo and len(left):
                i = todo.pop()
                for j in self.near(i, left).tolist():
                    new = left[kind[left] == kind[j]]
                    if len(new):
                        yield i, j
                        todo += new.tolist()
                        left = left[kind[left] != kind[j]]

    def every(self) -> Iterator[tuple[int, int]]:
        """All links that may be there between components."""
        _, kind = np.unique(self.root, return_inverse=True)
        largest = int(np.bincount(kind).argmax())
        rank = np.where(kind == largest, len(kind), np.arange(len(kind)))
        for i in np.flatnonzero(kind != largest).tolist():
            others = np.flatnonzero((kind != kind[i]) & (rank > i))
            for j in self.near(i, others).tolist():
                yield i, j


def grouped_links(groups: DataFrame) -> DataFrame:
    """(key, a, b) of the links that the walk finds in each row's `members`."""

    def run(batches):
        for b in pieces(batches, 16):
            keys = b["key"].to_pylist()
            starts, flat = b["members"].offsets.to_pylist(), b["members"].values
            node, root, size = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("node", "root", "size"))
            held = [flat.field(c) for c in ("bits", "odd", "parts") if flat.type.get_field_index(c) >= 0]
            for k, (s, e) in enumerate(zip(starts, starts[1:], strict=False)):
                group = Group(node[s:e], root[s:e], size[s:e], *[x.slice(s, e - s).to_pylist() for x in held])
                # fewer than its nodes
                found = [(int(group.node[i]), int(group.node[j])) for i, j in group.spanning()]
                if found:
                    yield links_of(found, keys[k])

    return groups.mapInArrow(run, "key long, a long, b long")


def links_of(found: list[tuple[int, int]], key: int | None = None) -> pa.RecordBatch:
    columns = {"a": [min(x) for x in found], "b": [max(x) for x in found]}
    if key is not None:
        columns = {"key": [key] * len(found), **columns}
    return batch(pa.schema([(c, pa.int64()) for c in columns]), columns)


def row_keys() -> tuple:
    """What stands for a row: its id, the largest number for null, and a key of its text."""
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    return number.alias("id"), F.xxhash64(text_column()).alias("text_key")


def signed(docs: DataFrame, tier: int = 0) -> DataFrame:
    """(id, text_key, node, size, bits, odd, keys) of every row.  `node` stands for the set and is
    null for an empty one, which has no keys."""
    index = runs(*TIERS[tier])
    schema = pa.schema(
        [("id", pa.int64()), ("text_key", pa.int64()), ("node", pa.int64()), ("size", pa.int64())]
        + [("bits", pa.binary()), ("odd", pa.binary()), ("keys", pa.list_(pa.int64()))]
    )

    def run(batches):
        for b in pieces(batches, 256):
            rows: dict[str, object] = {f.name: [] for f in schema}
            rows |= {"id": b["id"], "text_key": b["text_key"]}
            for text in utf8(b["text"]):
                parts = shingle_numbers(words(text))
                rows["size"].append(len(parts))
                if not len(parts):
                    for c in ("node", "bits", "odd", "keys"):
                        rows[c].append(None)
                    continue
                least = minima(parts)
                rows["node"].append(int.from_bytes(xxhash.xxh64_digest(parts.tobytes()), "big", signed=True))
                rows["bits"].append(packed(least))
                rows["odd"].append(parity(parts))
                rows["keys"].append(band_keys(least, index))
            yield batch(schema, rows)

    ddl = "id long, text_key long, node long, size long, bits binary, odd binary, keys array<long>"
    return docs.select(*row_keys(), text_column().alias("text")).mapInArrow(run, ddl)


def shared_keys(rows: DataFrame) -> DataFrame:
    """(key, node, n) of the nodes whose key others have, n nodes in all.  Of keys that the same
    nodes share one is kept."""
    indexed = rows.where("node is not null").select(F.explode("keys").alias("key"), "node")
    counted = indexed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    several = stored(counted.where("a <> b").select("key"))
    members = stored(indexed.join(sent(several), "key").distinct())
    same = [F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b"), F.bit_xor(F.xxhash64("node")).alias("x")]
    kept = members.groupBy("key").agg(*same).groupBy("n", "a", "b", "x").agg(F.min("key").alias("key"))
    return stored(members.join(sent(stored(kept.select("key", "n"))), "key"))


def texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, doc_id, text) of one document of each node."""
    rows = docs.select(*row_keys(), text_column().alias("text"))
    found = rows.join(sent(stored(nodes.select("node", "id", "text_key"))), ["id", "text_key"])
    # rows that repeat an id and a text give the same, one of which is enough
    return found.select("node", F.col("id").alias("doc_id"), "text").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets share PERCENT of their union."""
    wanted = sent(stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()))
    texts = stored(texts_of(docs, nodes.join(wanted, "node", "left_semi")))
    one, two = (texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")

    def run(batches):
        for b in pieces(batches, 64):
            kept = []
            last, sets = None, None
            for x, y, s, t in zip(*(b[c].to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                if x != last:
                    last, sets = x, shingle_numbers(words(s.encode()))
                other = shingle_numbers(words(t.encode()))
                both = len(np.intersect1d(sets, other, assume_unique=True))
                if 100 * both >= PERCENT * (len(sets) + len(other) - both):
                    kept.append((x, y))
            yield links_of(kept)

    both = pairs.join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return stored(both.mapInArrow(run, "a long, b long"))


def in_blocks(groups: DataFrame, blocks: Column) -> DataFrame:
    """Large groups as groups of two of their `blocks` each, every two of them."""
    blocks = blocks.cast("int")
    placed = groups.withColumn("g", F.pmod(F.xxhash64("node"), blocks)).withColumn(
        "h", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    key = F.xxhash64("key", F.least("g", "h"), F.greatest("g", "h"))
    return placed.select(key.alias("key"), "node")


def gathered(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, members) of groups (key, node), with what `nodes` has to compare them."""
    root = F.col("root" if "root" in nodes.columns else "node").alias("root")
    held = ["size", "bits", "odd", *(c for c in ("parts",) if c in nodes.columns)]
    sides = nodes.select("node", *(c for c in ("root",) if c in nodes.columns), *held)
    entry = F.struct("node", root, *held)
    return groups.join(sides, "node").groupBy("key").agg(F.collect_list(entry).alias("members"))


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, parts): the full set of each node."""

    def run(batches):
        schema = pa.schema([("node", pa.int64()), ("parts", pa.binary())])
        for b in pieces(batches, 64):
            parts = [shingle_numbers(words(text)).tobytes() for text in utf8(b["text"])]
            yield batch(schema, {"node": b["node"], "parts": parts})

    return stored(texts_of(docs, nodes).select("node", "text").mapInArrow(run, "node long, parts binary"))


def between(again: DataFrame, links: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b), there by the full sets, that connect what groups (key, node) hold of different
    components of `links`."""
    placed = again.join(connected_components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stored(placed.join(nodes.select("node", "size"), "node"))
    held = placed.groupBy("key").agg(
        F.min("root").alias("first"), F.max("root").alias("last"), F.sum("size").alias("held"), F.count("*").alias("n")
    )
    open_ = stored(held.where("first <> last").select("key", "held", "n"))
    if open_.isEmpty():
        return links.limit(0)
    some = placed.join(sent(open_), "key")
    blocks = F.least(F.ceil(2 * F.col("held") / SHINGLES), F.col("n"))
    heavy = F.col("held") > SHINGLES
    groups = some.where(~heavy).select("key", "node").union(in_blocks(some.where(heavy), blocks))
    known = stored(some.select("node", "root").distinct())
    sides = nodes.join(known, "node")
    sides = sides.join(sets_of(docs, nodes.join(known.select("node"), "node", "left_semi")), "node")
    return stored(grouped_links(gathered(groups, sides)).select("a", "b").distinct())


def similar_links(members: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that connect all that similar nodes of the same group are connected by."""
    # a group's links are fewer than its nodes
    walked = stored(grouped_links(gathered(members, nodes)))
    pairs = stored(walked.select("a", "b").distinct())
    links = confirmed(pairs, docs, nodes)
    if links.count() == pairs.count():
        return links
    # what a link that isn't there has hidden, in the groups that it was found in
    there = sent(stored(links.withColumn("there", F.lit(True))))
    told = walked.join(there, ["a", "b"], "left").where("there is null")
    gone = stored(told.select("key").distinct())
    return links.union(between(members.join(sent(gone), "key"), links, nodes, docs))


def similar_roots(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, root) of the nodes that links to similar nodes connect."""
    members = shared_keys(rows)
    some = sent(stored(members.select("node").distinct()))
    first = F.min_by(F.struct("id", "text_key", "size", "bits", "odd"), F.struct("id", "text_key")).alias("first")
    nodes = stored(rows.join(some, "node", "left_semi").groupBy("node").agg(first).select("node", "first.*"))
    links = rows.sparkSession.createDataFrame([], "a long, b long")
    for tier in range(len(TIERS)):
        small, large = members.where(F.col("n") <= GROUP), members.where(F.col("n") > GROUP)
        small = small.select("key", "node")
        if tier + 1 == len(TIERS):
            small = stored(small.union(in_blocks(large, F.ceil(F.col("n") / BLOCK))))
        links = links.union(similar_links(small, nodes, docs))
        if tier + 1 == len(TIERS) or large.isEmpty():
            break
        again = texts_of(docs, nodes.join(large.select("node").distinct(), "node", "left_semi"))
        members = shared_keys(stored(signed(again, tier + 1).select("node", "keys")))
    return connected_components(links)


@in_scope
def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles (distinct shingles), component_id (the smallest doc_id
    that links reach, its own included), kept (the two are equal).

    Null and empty texts, and texts without words, have no shingles and are linked with nothing.
    A null doc_id counts only where all ids of its component are null; then the component's id is
    null and the row is kept.  Repeated rows each get a row.  A long text is one set like any
    other; an empty table gives no rows."""
    rows = stored(signed(docs))
    roots = similar_roots(rows, docs)
    thin = rows.select("id", "node", "size")
    firsts = thin.where("node is not null").groupBy("node").agg(F.min("id").alias("first"))
    grouped = stored(firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    ids = grouped.groupBy("root").agg(F.min("first").alias("component"))
    found = stored(grouped.join(ids, "root").select("node", "component"))
    none = F.lit(2**63 - 1)
    return (
        thin.join(found, "node", "left")
        .select(
            F.nullif("id", none).alias("doc_id"),
            F.col("size").alias("n_shingles"),
            F.nullif(F.coalesce("component", "id"), none).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
