"""Near-duplicates by SimHash fingerprints and Burkhard-Keller trees.

A fingerprint has 64 bits; texts are linked when theirs differ in at most `radius` bits.
Fingerprints are sharded so that every linked pair meets in a shard: the bits are four blocks of
16, and two fingerprints at most two bits apart agree in two blocks, so a shard is a pair of
blocks with its value. In a shard a tree is built whose children are keyed by their Hamming
distance to the parent; a search follows only edges within the radius of its own distance. A
shard with more than `shard_limit` fingerprints is divided by the same rule on its other 32
bits, which leaves 16 free bits, so no tree has more than 65,536 nodes.

A shard's tree goes to the task that holds the shard's fingerprints, not to all executors: all
trees together grow with the corpus, so a broadcast would have no bound.

In a shard, links are reduced to one per fingerprint that joins another group (a forest), so
large groups give as many rows as they have members. Equal texts share one fingerprint row.

`keep_one` links texts by the Jaccard similarity of their shingles. Texts at a similarity of 0.8 differ in about ten bits
of 64, more than blocks of bits can bound, so its shards are the groups of texts that share a shingle (similar.py), in
which all similar texts meet: a tree per group is searched with a radius of `KEEP_RADIUS` bits, what it finds is compared by whole
shingle sets, and pairs that lie further apart in bits, or in groups of over `TREE_LIMIT`, are searched exactly.

Nulls: a null text is an empty one, with fingerprint zero, which links like any other. A null id
takes part and is never the smallest unless a component has no other. Repeated rows are in
one component. An empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.components import connected
from tidegauge.llm.shingles import shingle_hashes
from tidegauge.llm.similar import similar_components, sketches
from tidegauge.llm.tables import Folders, carried, lean, stored, text_of
from tidegauge.session import fits_broadcast

SHARD_LIMIT = 512
# Bits within which near copies are looked for in a group, and the members of a group that has a tree.
KEEP_RADIUS = 16
TREE_LIMIT = 128
# Rows and bytes that a join may broadcast; a hash table on the driver takes three to five times these bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 8 << 20

# Each bit of a byte in a lane of its own.
_LANES = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
          .copy().view(np.uint64).ravel())


def majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each slice of the hashes, the bits set in over half of them."""
    out = np.zeros(len(offsets) - 1, np.uint64)
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    # Lanes of eight bits hold sums of up to 255 hashes: slices are summed in pieces.
    pieces = -(-sizes[full] // 255)
    first = np.cumsum(pieces) - pieces
    number = np.arange(int(pieces.sum())) - np.repeat(first, pieces)
    starts = np.repeat(offsets[full], pieces) + number * 255
    columns = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    half = sizes[full]
    for byte in range(8):
        sums = np.add.reduceat(_LANES[columns[:, byte]], starts)
        counts = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        bits = (2 * counts > half[:, None]).astype(np.uint64)
        out[full] |= (bits << np.arange(8, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) << np.uint64(8 * byte)
    return out


def fingerprints(docs: DataFrame, words: int = 3, text_column: str = "text", name: str = "fingerprint",
                 keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all by default) of `docs` and the fingerprint as a signed 64-bit integer."""
    keep = docs.columns if keep is None else keep

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, offsets = [], [0]
            for text in batch.column("_text"):
                hashes += shingle_hashes(text.as_buffer().to_pybytes(), words)
                offsets.append(len(hashes))
            prints = majority(np.array(hashes, np.uint64), np.array(offsets))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(prints.view(np.int64))],
                                             names=[*keep, name])

    types = dict(docs.dtypes)
    return docs.select(*keep, text_of(text_column).alias("_text")).mapInArrow(
        run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), f"`{name}` long"]))


class Tree:
    """A Burkhard-Keller tree of 64-bit integers under the Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int, radius: int) -> list[int]:
        """Insert a value; the numbers of the earlier ones within `radius`."""
        near: list[int] = []
        if not self.values:
            self.values.append(value)
            self.children.append({})
            return near
        todo = [0]
        while todo:
            node = todo.pop()
            d = (self.values[node] ^ value).bit_count()
            if d <= radius:
                near.append(node)
            for edge, child in self.children[node].items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)
        node = 0
        while True:
            d = (self.values[node] ^ value).bit_count()
            child = self.children[node].get(d)
            if child is None:
                self.children[node][d] = len(self.values)
                self.values.append(value)
                self.children.append({})
                return near
            node = child


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the distinct values in a shard."""
    tree, parent, links = Tree(), list(range(len(values))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, value in enumerate(values):
        for j in sorted(tree.add(value & 0xFFFF_FFFF_FFFF_FFFF, radius)):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((value, values[j]))
    return links


def _block(value: Column, i: int) -> Column:
    return F.shiftrightunsigned(value, 16 * i).bitwiseAND(0xFFFF)


def _shards(prints: DataFrame) -> DataFrame:
    keys = [F.struct(F.lit(k).alias("k"), (_block(F.col("v"), i) * 65536 + _block(F.col("v"), j)).alias("s"))
            for k, (i, j) in enumerate(combinations(range(4), 2))]
    return prints.select("v", F.inline(F.array(*keys)))


def _inner_shards(rows: DataFrame) -> DataFrame:
    """Shards of the two blocks that the outer shard leaves open, in bytes."""
    pairs = list(combinations(range(4), 2))
    out = None
    for k, (i, j) in enumerate(pairs):
        a, b = (_block(F.col("v"), x) for x in range(4) if x not in (i, j))
        parts = [a.bitwiseAND(255), F.shiftrightunsigned(a, 8), b.bitwiseAND(255), F.shiftrightunsigned(b, 8)]
        keys = [F.struct(F.lit(n).alias("k2"), (parts[x] * 256 + parts[y]).alias("s2"))
                for n, (x, y) in enumerate(pairs)]
        own = rows.where(F.col("k") == k).select("v", "k", "s", F.inline(F.array(*keys)))
        out = own if out is None else out.unionByName(own)
    return out


def links(prints: DataFrame, radius: int = 2, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """(a, b) links of a forest over the distinct fingerprints in `prints` (one column, v: long)
    that has the same components as all links of at most `radius` bits."""
    if not 0 <= radius <= 2:
        raise ValueError("the shards are exact for a radius of at most 2")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for values in batch.column("vs").to_pylist() for x in forest(values, radius)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()),
                                              pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

    shards = _shards(prints)
    sizes = stored(shards.groupBy("k", "s").count().where("count > 1"), "shards")
    shared = shards.join(sizes, ["k", "s"])
    small = shared.where(F.col("count") <= shard_limit).groupBy("k", "s").agg(F.collect_list("v").alias("vs"))
    # At most 2^16 values of a group: 48 of the bits are equal.
    inner = _inner_shards(shared.where(F.col("count") > shard_limit)).groupBy("k", "s", "k2", "s2").agg(
        F.collect_list("v").alias("vs")).where(F.size("vs") > 1)
    return small.select("vs").unionByName(inner.select("vs")).mapInArrow(run, "a long, b long")


def group_links(members: DataFrame, radius: int = KEEP_RADIUS) -> DataFrame:
    """(a, b), a < b, of a forest in each group whose links are at most `radius` bits long. members: h (the group), v
    (a node), print (its fingerprint, signed). A group's tree is in one row."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            offsets = batch.column(0).offsets.to_pylist()
            nodes, prints = (batch.column(c).values.to_pylist() for c in range(2))
            for i, j in zip(offsets, offsets[1:]):
                first: dict[int, int] = {}
                for node, value in zip(nodes[i:j], prints[i:j]):
                    if first.setdefault(value, node) != node:
                        found.append((first[value], node))
                # Values are in the order of their nodes, so links go to smaller ones.
                found += [(first[b], first[a]) for a, b in forest(list(first), radius)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()),
                                              pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

    groups = members.groupBy("h").agg(F.sort_array(F.collect_set(F.struct("v", "print"))).alias("m")).where(F.size("m") > 1)
    return groups.select("m.v", "m.print").mapInArrow(run, "a long, b long")


def components(docs: DataFrame, words: int = 3, radius: int = 2, id_column: str = "doc_id",
               text_column: str = "text", shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """doc_id, fingerprint (signed), component_id (the smallest doc_id reachable) of every row."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    rows = stored(fingerprints(rows, words, name="v", keep=["doc_id"]), "fingerprints")
    members = stored(rows.groupBy("v").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = connected(links(members.select("v"), radius, shard_limit))
    named = members.join(roots, F.col("v") == F.col("node"), "left").select(
        "v", "least", F.coalesce("root", "v").alias("root"))
    named = stored(named, "fingerprints")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = named.join(least, "root").select("v", "component_id")
    return rows.join(found, "v").select("doc_id", F.col("v").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_column: str = "doc_id",
             text_column: str = "text", radius: int = KEEP_RADIUS) -> DataFrame:
    """The documents with one row of each component of texts whose `words`-word shingles have a
    Jaccard similarity of at least `similarity`: the one with the smallest id (a null id is the
    last), then the smallest text digest. All columns are kept. Fingerprint trees find the pairs within
    `radius` bits; the radius has no influence on the result, only on how much is left to the exact search."""
    bound = Fraction(str(similarity))
    folders = Folders(docs.sparkSession)
    digest = F.md5(text_of(text_column).cast("binary")).alias("digest")
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"), digest)
    texts = rows
    rows = folders.store(sketches(rows, words, bound, ["doc_id", "digest"], majority=majority), "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("digest").alias("d"))
    members = folders.store(rows.groupBy("v").agg(F.min(order).alias("first")), "members")
    roots = similar_components(rows, members.select("v", "first.id", F.col("first.d").alias("digest")), texts, words, bound,
                               folders, lambda groups: group_links(groups, radius), TREE_LIMIT)
    first = members.join(roots, F.col("v") == F.col("node"), "left").groupBy(F.coalesce("root", "v").alias("root")).agg(
        F.min("first").alias("first")).select(F.col("first.id").alias("_id"), F.col("first.d").alias("_digest"))

    def same(a: DataFrame, b: DataFrame):
        return (a["digest"] == b["_digest"]) & a["doc_id"].eqNullSafe(b["_id"])

    # What goes is less than what stays, and rows that repeat are less still; both are of ids and digests only.
    own = folders.store(rows.groupBy("doc_id", "digest").agg(F.count("*").alias("n")), "own")
    kept = folders.store(own.join(first, same(own, first), "left_semi"), "kept")
    ends = [F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")]
    named = own.select(*ends)
    lost = stored(named.join(kept, same(kept, named), "left_anti"), "lost")
    repeated = stored(kept.where("n > 1").select(*ends), "repeated")
    folders.close()
    lost, repeated = (F.broadcast(x) if fits_broadcast(x, BROADCAST_ROWS, BROADCAST_BYTES) else x for x in (lost, repeated))
    all_rows = carried(docs, F.col(id_column).alias("doc_id"), digest)
    left = all_rows.join(lost, same(all_rows, lost), "left_anti")
    once = left.join(repeated, same(left, repeated), "left_anti")
    again = left.join(repeated, same(left, repeated), "left_semi").dropDuplicates(["doc_id", "digest"])
    return once.unionByName(again).select("row.*")
