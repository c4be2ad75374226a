"""SimHash near-duplicates by deletion variants.

Fingerprints of 64 bits that differ in at most three are cut into two segments of 32, one of which
then differs in at most one.  Each fingerprint is indexed under its segments with one bit deleted,
32 variants a segment; links have a variant in common.  A group of equal variants is checked in
one task and answers with a few links that connect what it found, never with all its pairs.

A group larger than `GROUP` is cut again: the other segment's halves with one bit deleted.  What
such a group holds differs in 18 bits at most, so its size has a bound whatever the data is.

Null texts count as empty and have fingerprint zero, which is linked like any other; null ids are
ignored when the smallest id is sought; an empty table gives no rows."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.llm.common import batch, pieces, stored, text_column, utf8, words
from devpulse.llm.components import connected_components
from devpulse.sources.sinks import in_scope

SEED = 42
DISTANCE = 3
# most members of a group of equal variants that is checked as it is
GROUP = 512
# groups of several members up to this many (20 bytes each) are sent to all tasks; beyond, the
# index is shuffled a second time to meet them
SENT_GROUPS = 1_000_000
# links that a task gathers from several groups before they go out
HELD = 10_000


def shingles(found: list[bytes], n: int) -> list[bytes]:
    """Runs of n words, repeats included; the whole sequence where it is shorter; none of none."""
    if len(found) < n:
        return [b" ".join(found)] if found else []
    return list(map(b" ".join, zip(*(found[i:] for i in range(n)), strict=False)))


def bits(features: list[bytes], seed: int = SEED) -> np.ndarray:
    """A row of 64 bits for each feature, highest first."""
    data = b"".join([xxhash.xxh64_digest(x, seed) for x in features])
    return np.unpackbits(np.frombuffer(data, np.uint8).reshape(-1, 8), axis=1)


def fingerprint(found: list[bytes], n: int = 3) -> int:
    """A bit is set if it is in over half the shingles' hashes.  Signed, as Spark keeps it."""
    features = shingles(found, n)
    total = np.zeros(64, np.int64)
    for start in range(0, len(features), 4096):
        total += bits(features[start : start + 4096]).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(features)).tobytes(), "big", signed=True)


def variants(prints: DataFrame) -> DataFrame:
    """`prints` (node, f, fp: which fingerprint, and it) by the variants of both segments:
    (key, fp, node).  A key holds f and the variant's number, eight bits in all, and the segment
    without its bit."""
    segment = "(shiftrightunsigned(fp, 32 * (v div 32)) & 4294967295L)"
    key = f"shiftleft(cast(64 * f + v as long), 32) | ({segment} & ~shiftleft(1L, v % 32))"
    numbered = prints.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(63))))
    return numbered.select(F.expr(key).alias("key"), "fp", "node")


def subvariants(members: DataFrame) -> DataFrame:
    """Members of large groups by the variants of the other segment's halves: adds `sub`."""
    other = "(1 - cast(shiftright(key, 32) & 63 as int) div 32)"
    half = f"(shiftrightunsigned(fp, 32 * {other} + 16 * (w div 16)) & 65535L)"
    return members.withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(31)))).withColumn(
        "sub", F.expr(f"shiftleft(cast(w as long), 16) | ({half} & ~shiftleft(1L, w % 16))")
    )


def spanning(fps: np.ndarray, nodes: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links within the distance that connect all that such links connect: one a member at most.
    Walks from member to member, each asking only for those not yet reached."""
    links = []
    left = np.arange(len(fps))
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            i = todo.pop()
            hit = np.bitwise_count(fps[left] ^ fps[i]) <= distance
            for j in left[hit]:
                links.append((int(nodes[i]), int(nodes[j])))
                todo.append(j)
            left = left[~hit]
    return links


def grouped_links(grouped: DataFrame) -> DataFrame:
    """(a, b) of the links that connect each row's `members` (structs of fp and node)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for b in pieces(batches, 64):
            members = b["members"]
            starts, flat = members.offsets.to_pylist(), members.values
            fps = flat.field("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            nodes = flat.field("node").to_numpy(zero_copy_only=False)
            links: list[tuple[int, int]] = []
            for s, e in zip(starts, starts[1:], strict=False):
                links += spanning(fps[s:e], nodes[s:e])
                if len(links) > HELD or e == starts[-1]:
                    yield batch(schema, {"a": [x[0] for x in links], "b": [x[1] for x in links]})
                    links = []

    return grouped.select("members").mapInArrow(run, "a long, b long")


def candidate_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between nodes whose fingerprints have a variant in common: both nodes of a
    group of two, whatever their distance, and what `spanning` picks in larger groups.

    Groups are counted before anything is gathered: single members go at once, pairs are known
    from their smaller and larger node, groups up to GROUP are gathered by their key, and larger
    ones by the second cut."""
    indexed = variants(prints)
    counted = indexed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b")
    )
    counted = stored(counted.where("n > 1"))
    shared = counted.where("n > 2").select("key", "n")
    sent = F.broadcast(shared) if shared.count() <= SENT_GROUPS else shared
    members = stored(indexed.join(sent, "key"))
    gather = F.collect_list(F.struct("fp", "node")).alias("members")
    small = members.where(F.col("n") <= GROUP).groupBy("key").agg(gather)
    large = subvariants(members.where(F.col("n") > GROUP)).groupBy("key", "sub").agg(gather)
    gathered = small.select("members").union(large.where(F.size("members") > 1).select("members"))
    pairs = counted.where("n = 2").select("a", "b").distinct()
    return stored(grouped_links(gathered).union(pairs).distinct())


def within(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def fingerprints(docs: DataFrame, n: int = 3) -> DataFrame:
    """(id, text_key, fp) of every row; `id` and `text_key` as in `row_keys`."""
    schema = pa.schema([("id", pa.int64()), ("text_key", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in pieces(batches):
            fps = [fingerprint(words(x), n) for x in utf8(b["text"])]
            yield batch(schema, {"id": b["id"], "text_key": b["text_key"], "fp": fps})

    return docs.select(*row_keys(), text_column().alias("text")).mapInArrow(
        run, "id long, text_key long, fp long"
    )


def row_keys() -> tuple[Column, Column]:
    """What stands for a row: its id, and a key of its text."""
    return F.col("doc_id").cast("long").alias("id"), F.xxhash64(text_column()).alias("text_key")


def classes(signed: DataFrame) -> DataFrame:
    """(fp, root) of every fingerprint in `signed`, root being the same for all that links reach."""
    prints = stored(signed.select(F.col("fp").alias("node"), F.lit(0).alias("f"), "fp").distinct())
    # a node is its fingerprint here
    links = candidate_links(prints).where(within(F.col("a"), F.col("b")))
    roots = connected_components(links).withColumnRenamed("node", "fp")
    return prints.select("fp").join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


@in_scope
def near_duplicates(docs: DataFrame, n: int = 3) -> DataFrame:
    """Per document: doc_id, fingerprint (hexadecimal), component_id (the smallest doc_id that
    links of fingerprints reach, its own included; null if all of them are null)."""
    signed = stored(fingerprints(docs, n))
    grouped = stored(classes(signed))
    firsts = signed.groupBy("fp").agg(F.min("id").alias("first")).join(grouped, "fp")
    ids = stored(firsts.groupBy("root").agg(F.min("first").alias("component_id")))
    found = stored(grouped.join(ids, "root").select("fp", "component_id"))
    return signed.join(found, "fp").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@in_scope
def survivors(docs: DataFrame, n: int = 3) -> DataFrame:
    """(id, text_key, copies) of the row to keep of each class: the smallest id, null as largest,
    then the smallest key; `copies` says how often that row is there."""
    signed = stored(fingerprints(docs, n))
    rows = signed.groupBy("fp", "id", "text_key").agg(F.count("*").alias("copies"))
    entry = F.struct(F.col("id").isNull().alias("last"), "id", "text_key", "copies")
    best = rows.groupBy("fp").agg(F.min(entry).alias("first"))
    best = best.join(classes(signed), "fp").groupBy("root").agg(F.min("first").alias("first"))
    return best.select("first.id", "first.text_key", "first.copies")


def keep_one(docs: DataFrame, n: int = 3) -> DataFrame:
    """`docs` with one document of each class of `near_duplicates`: the one of the smallest id
    (null ids count as largest, then the smallest key of the text), once if its row is repeated.

    Texts without words, null ones included, have fingerprint zero and are one class; a very long
    text is one fingerprint like any other; an empty table stays empty."""
    kept = survivors(docs, n)
    # whole rows in one column, so that no column of theirs meets one of ours
    rows = docs.select(F.struct([F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *row_keys())
    same = rows["id"].eqNullSafe(kept["id"]) & (rows["text_key"] == kept["text_key"])
    out = rows.join(kept.select("id", "text_key"), same, "left_semi")
    if not kept.where("copies > 1").isEmpty():
        out = out.dropDuplicates(["id", "text_key"])
    return out.select("doc.*")
