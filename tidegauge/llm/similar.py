"""Pairs of texts with a shingle Jaccard similarity of at least a bound, exactly.

A text is the set of its runs of `words` words. Sets are put in one common order; two sets of n
and m shingles that are similar enough have at least ceil(bound * n) in common, so they share a
shingle among the first n - ceil(bound * n) + 1 of each (prefix filter). Only these prefixes are
shuffled. Any common order finds all pairs. Here shingles that are frequent in a sample of the texts
come last and others by hash, so frequent ones seldom are in a prefix; the sample has no influence on
results.

A candidate pair has to pass two filters that lose no similar pair: the sizes, and the parity sketch, about
four bits per shingle of which bit i says whether an odd number of shingles hash to i. Sketches differ
in at most as many bits as sets differ in shingles, sets that are similar enough differ in few, and
a longer sketch is folded to the length of a shorter one. What passes is nearly always similar. It is
compared with whole sets: each set is made once, and of a pair one set is sent to the other. Sketches
folded to `SHORT_BITS` are compared before the whole ones, so these travel for few pairs.

Only components are wanted, so large groups (texts that share a prefix shingle) do not give all their pairs.
Members are compared with those that the caller names first (simhash.py: fingerprint trees), in groups too large for that with one
head. In groups that still have several components, members are compared with the `HUBS` that have most links, and what is apart then is
searched in the group's task by sketches, which gives the passing pairs of different components only.
Texts with equal sets are one node. The rows of a group are sorted on disk; in the last search its
task holds the sketches of the members of a group with several components.

Nulls: a null text is an empty one, whose set is empty; empty sets are one node, equal to each other and
similar to no other. Null ids and repeated rows are the caller's (see simhash.keep_one). An empty table has no
nodes. Only the columns named are read, and the functions name their own columns, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.components import connected
from tidegauge.llm.shingles import shingle_hashes, shingle_set
from tidegauge.llm.tables import Folders, lean, text_of, utf8
from tidegauge.session import fits_broadcast

HUBS = 3
SAMPLE = 10_000
FREQUENT = 100_000
# What a join may broadcast of the rows of pairs; a hash table on the driver takes three to five times these bytes. Sketches
# grow with the corpus and are joined by shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 8 << 20
# Bits of a sketch, at least and at most, and those of the short form that is compared first.
PARITY_BITS = 256, 1 << 20
SHORT_BITS = 1024
# Members that are compared with one copy of a head's set.
STAR = 5_000


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate([*rows, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def frequent(docs: DataFrame, words: int, text_column: str = "text") -> np.ndarray:
    """Shingles of at least a thousandth of a sample's texts (eight of them at least)."""
    share = min(1.0, SAMPLE / max(1, docs.count()))
    texts = docs.select(text_of(text_column).alias("text")).sample(share, seed=1)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_buffer().to_pybytes(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([_lists(sets)], names=["shingles"])

    counts = texts.mapInArrow(run, "shingles array<long>").select(F.explode("shingles").alias("h")).groupBy("h").count()
    top = counts.where(F.col("count") >= max(8, SAMPLE // 1000)).orderBy(F.desc("count")).limit(FREQUENT).select("h")
    return np.sort(np.array([r.h for r in top.collect()], np.int64).view(np.uint64))


def parity(shingles: np.ndarray) -> bytes:
    """The parity sketch of a set."""
    least, most = PARITY_BITS
    bits = min(most, max(least, 1 << max(0, 4 * len(shingles) - 1).bit_length()))
    place = (shingles >> np.uint64(65 - bits.bit_length())).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(bool), bitorder="little").tobytes()


def folded(sketch: np.ndarray) -> np.ndarray:
    """Sketches (rows of bytes) of half the bits: places are the first bits of a hash."""
    bits = np.unpackbits(sketch, axis=-1, bitorder="little")
    return np.packbits(bits[..., 0::2] ^ bits[..., 1::2], axis=-1, bitorder="little")


def shortened(sketch: bytes) -> bytes:
    """A sketch folded to at most SHORT_BITS."""
    bits = np.frombuffer(sketch, np.uint8)
    while 8 * len(bits) > SHORT_BITS:
        bits = folded(bits)
    return bits.tobytes()


def sketches_differ(a: bytes, b: bytes) -> int:
    """In how many bits two sketches differ, after the longer one is folded."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = folded(x)
    while len(y) > len(x):
        y = folded(y)
    return int(np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)).sum())


def sketches(docs: DataFrame, words: int, bound: Fraction, keep: list[str], text_column: str = "text", *,
             majority: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Columns `keep`, a hash of the set (v), its size (n), and for the first text of each set in a
    task its parity sketch, prefix and fingerprint (print), which `majority` makes of the hashes of all shingles."""
    late = frequent(docs, words, text_column)
    p, q = bound.numerator, bound.denominator

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as xxh

        seen: set[int] = set()
        for batch in batches:
            hashes, sizes, prefixes, parities, fresh, every = [], [], [], [], [], []
            for text in batch.column("_text"):
                repeated = np.array(shingle_hashes(text.as_buffer().to_pybytes(), words), np.uint64)
                own = np.unique(repeated)
                n, v = len(own), xxh(own.tobytes(), 1)
                hashes.append(v)
                sizes.append(n)
                fresh.append(v not in seen)
                every.append(repeated if v not in seen else repeated[:0])
                if v in seen:
                    prefixes.append(own[:0])
                    parities.append(None)
                    continue
                seen.add(v)
                parities.append(parity(own))
                if n and len(late):
                    at = np.minimum(np.searchsorted(late, own), len(late) - 1)
                    last = late[at] == own
                    own = np.concatenate([own[~last], own[last]])
                prefixes.append(own[:n - -(-p * n // q) + 1])
            prints = majority(np.concatenate([*every, np.zeros(0, np.uint64)]), np.cumsum([0, *map(len, every)]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(np.array(hashes, np.uint64).view(np.int64)),
                 pa.array(sizes, pa.int32()), pa.array(fresh, pa.bool_()), pa.array(parities, pa.binary()), _lists(prefixes),
                 pa.array(prints.view(np.int64))],
                names=[*keep, "v", "n", "fresh", "parity", "prefix", "print"])

    types = dict(docs.dtypes)
    return docs.select(*keep, text_of(text_column).alias("_text")).mapInArrow(run, ", ".join(
        [*(f"`{c}` {types[c]}" for c in keep), "v long, n int, fresh boolean, parity binary, prefix array<long>, print long"]))


def _sets(texts: DataFrame, wanted: DataFrame, words: int, folders: Folders) -> DataFrame:
    """(v, shingles) of the wanted nodes. texts: doc_id, digest, text; wanted: v, id, digest."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fresh = []
            for i, v in enumerate(batch.column(0).to_pylist()):
                if v not in seen:
                    seen.add(v)
                    fresh.append(i)
            batch = batch.take(pa.array(fresh, pa.int64()))
            sets = [shingle_set(t.as_buffer().to_pybytes(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(sets)], names=["v", "shingles"])

    # Without a broadcast all texts would be shuffled to find the few that are in a pair.
    wanted = F.broadcast(wanted) if fits_broadcast(wanted, BROADCAST_ROWS, BROADCAST_BYTES) else wanted
    named = texts.join(wanted, (texts["digest"] == wanted["digest"]) & texts["doc_id"].eqNullSafe(wanted["id"]))
    return folders.store(named.select("v", "text").mapInArrow(run, "v long, shingles array<long>"), "sets")


class Verifier:
    """Confirms candidate pairs. nodes: v, n, parity, one row per node; members: v, id, digest of a text of
    each; texts: doc_id, digest, text."""

    def __init__(self, nodes: DataFrame, members: DataFrame, texts: DataFrame, words: int, bound: Fraction, folders: Folders):
        self.nodes, self.members, self.texts = nodes, members, texts

        @lean
        def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                short = pa.array([shortened(x.as_py()) for x in batch.column(2)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), short], names=["v", "n", "parity"])

        self.short = folders.store(nodes.select("v", "n", "parity").mapInArrow(shorten, "v long, n int, parity binary"), "short")
        self.words, self.bound, self.folders = words, bound, folders
        self.sets: DataFrame | None = None

    def passing(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs (a, b) that the sizes and sketches of `nodes` allow."""
        p, q = self.bound.numerator, self.bound.denominator
        both = pairs
        for end in "ab":
            own = nodes.select(F.col("v").alias(end), F.col("n").cast("long").alias(f"n{end}"), F.col("parity").alias(f"p{end}"))
            both = both.join(own, end)

        @lean
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
                apart = np.array([sketches_differ(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5))], np.int64)
                # |A and B| >= p / (p + q) (n + m), so the sets differ in at most (q - p) / (p + q) (n + m).
                yield batch.select(["a", "b"]).filter(pa.array((p + q) * apart <= (q - p) * n))

        sizes = both.where(q * F.least("na", "nb") >= p * F.greatest("na", "nb"))
        return sizes.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, "a long, b long")

    def _prepare(self, pairs: DataFrame) -> DataFrame:
        """The sets of all nodes in the pairs; those of earlier pairs are not made again."""
        asked = pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct()
        if self.sets is not None:
            asked = asked.join(self.sets.select("v"), "v", "left_anti")
        new = _sets(self.texts, self.folders.store(self.members.join(asked, "v"), "wanted"), self.words, self.folders)
        self.sets = new if self.sets is None else self.sets.unionByName(new)
        return self.sets

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose whole sets are similar, stored."""
        folders, p, q = self.folders, self.bound.numerator, self.bound.denominator
        # Short sketches leave few pairs, for which the whole ones are joined.
        pairs = folders.store(self.passing(pairs.distinct(), self.short), "pairs")
        pairs = folders.store(self.passing(pairs, self.nodes), "pairs")
        sets = self._prepare(pairs)
        # A head with many members has copies of its set, each for a part of them.
        heads = pairs.groupBy("a").agg(F.expr(f"(count(*) - 1) div {STAR} + 1").alias("parts"))
        heads = folders.store(heads, "heads")
        slots = pairs.join(heads, "a").select("a", F.col("b").alias("v"), F.pmod(F.xxhash64("b"), "parts").alias("part"))
        copies = heads.select("a", F.col("a").alias("v"), F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"))
        asked = slots.withColumn("head", F.lit(False)).unionByName(copies.withColumn("head", F.lit(True)))
        asked = folders.store(asked, "asked")
        asked = F.broadcast(asked) if fits_broadcast(asked, BROADCAST_ROWS, BROADCAST_BYTES) else asked
        sent = asked.join(sets, "v").repartition("a", "part").sortWithinPartitions("a", "part", F.desc("head"))

        @lean
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, head = None, np.zeros(0, np.int64)
            for batch in batches:
                found = []
                a, v, part = (batch.column(c).to_numpy() for c in range(3))
                is_head, sets = batch.column(3).to_pylist(), batch.column(4)
                offsets, values = sets.offsets.to_numpy(), sets.values.to_numpy()
                for i in range(len(a)):
                    own = values[offsets[i]:offsets[i + 1]]
                    if is_head[i]:
                        current, head = (a[i], part[i]), own.copy()
                    elif current == (a[i], part[i]):
                        at = np.minimum(np.searchsorted(head.view(np.uint64), own.view(np.uint64)), max(0, len(head) - 1))
                        common = int((head[at] == own).sum()) if len(head) else 0
                        if (p + q) * common >= p * (len(head) + len(own)):
                            found.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(a[found]), pa.array(v[found])], names=["a", "b"])

        sent = sent.select("a", "v", "part", "head", "shingles")
        return folders.store(sent.mapInArrow(run, "a long, b long"), "similar")


def _search(rows: DataFrame, bound: Fraction) -> DataFrame:
    """Pairs (a, b) of one group (h) in different components that sizes and short sketches allow. rows:
    h, n, v, root, parity."""
    p, q = bound.numerator, bound.denominator

    def pairs(n: np.ndarray, v: np.ndarray, root: np.ndarray, raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """`n` rises, and a longer set has a sketch of the same length or, within the bound, twice that."""
        size = np.array([len(x) for x in raw])
        rows = {s: np.flatnonzero(size == s) for s in np.unique(size).tolist()}
        own = {s: np.stack([np.frombuffer(raw[i], np.uint8) for i in at]) for s, at in rows.items()}
        levels = {s: [(rows[s], own[s].view(np.uint64))] for s in rows}
        for s in rows:
            if s // 2 in rows:
                levels[s // 2].append((rows[s], np.ascontiguousarray(folded(own[s])).view(np.uint64)))
        ends = np.searchsorted(n, n * q // p, side="right")
        for s, at in rows.items():
            mine = own[s].view(np.uint64)
            for place, i in enumerate(at.tolist()):
                for others, sketch in levels[s]:
                    first, last = np.searchsorted(others, (i + 1, ends[i]))
                    j = others[first:last]
                    apart = root[j] != root[i]
                    if apart.any():
                        j = j[apart]
                        differ = np.bitwise_count(sketch[first:last][apart] ^ mine[place]).sum(axis=1, dtype=np.int64)
                        j = j[(p + q) * differ <= (q - p) * (n[i] + n[j])]
                        yield np.minimum(v[i], v[j]), np.maximum(v[i], v[j])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
            h, n, v, root = (batch.column(c).to_numpy() for c in range(4))
            return [h, n.astype(np.int64), v, root, np.array(batch.column(4).to_pylist(), object)]

        held: list[list[np.ndarray]] = []

        def closed() -> Iterator[pa.RecordBatch]:
            group = [np.concatenate(x) for x in zip(*held)]
            for a, b in pairs(*group[1:]):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            own = columns(batch)
            edges = [0, *(np.flatnonzero(np.diff(own[0])) + 1).tolist(), len(own[0])]
            for i, j in zip(edges, edges[1:]):
                if held and i < j and held[0][0][0] != own[0][i]:
                    yield from closed()
                    held.clear()
                if i < j:
                    held.append([x[i:j] for x in own])
        if held:
            yield from closed()

    sent = rows.select("h", "n", "v", "root", "parity").repartition("h").sortWithinPartitions("h", "n", "v")
    return sent.mapInArrow(run, "a long, b long")


def similar_components(rows: DataFrame, members: DataFrame, texts: DataFrame, words: int, bound: Fraction,
                       folders: Folders, near: Callable[[DataFrame], DataFrame], near_limit: int) -> DataFrame:
    """(node, root) of the sets in a link. rows: sketches; members: v, id, digest of one text of each
    set; texts: doc_id, digest, text. `near` gives the pairs (a, b) that are compared first of groups (h, v, print) with
    at most `near_limit` members. The result is stored; what else is written ends with `folders`."""
    fresh = rows.where("fresh")
    group = Window.partitionBy("h")
    ends = [F.least("head", "v").alias("a"), F.greatest("head", "v").alias("b")]
    grouped = fresh.select("v", "print", F.explode("prefix").alias("h")).withColumns(
        {"head": F.min("v").over(group), "last": F.max("v").over(group), "many": F.count("*").over(group)})
    grouped = folders.store(grouped.where("head <> last").drop("last"), "groups")
    nodes = folders.store(grouped.select("v").distinct().join(fresh.select("v", "n", "parity"), "v").groupBy("v").agg(
        F.first("n").alias("n"), F.first("parity").alias("parity")), "nodes")
    verifier = Verifier(nodes, members, texts, words, bound, folders)

    def apart(left: DataFrame, roots: DataFrame) -> DataFrame:
        """Rows with their component, of the groups that have several."""
        rooted = folders.store(left.select("h", "v").join(roots, F.col("v") == F.col("node"), "left").select(
            "h", "v", F.coalesce("root", "v").alias("root")), "shared")
        several = rooted.groupBy("h").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s")
        return folders.store(rooted.join(several.select("h"), "h"), "shared")

    large = grouped.where((F.col("many") > near_limit) & (F.col("v") != F.col("head"))).select(*ends)
    links = verifier.confirmed(near(grouped.where(F.col("many") <= near_limit)).unionByName(large))
    left = apart(grouped, connected(links))

    # Then with the members that have most links: texts that others are edited from.
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("d"))
    place = F.row_number().over(group.orderBy(F.coalesce("d", F.lit(0)).desc(), "v"))
    hubs = left.join(degree, F.col("v") == F.col("node"), "left").withColumn("place", place).where(
        F.col("place") <= HUBS).select("h", F.col("v").alias("head"), F.col("root").alias("own"))
    stars = left.join(hubs, "h").where("root <> own").select(*ends)
    links = links.unionByName(verifier.confirmed(stars))
    left = apart(left, connected(links))

    # What is still apart, by a search in each group.
    rest = _search(left.join(verifier.short, "v"), bound)
    return connected(links.unionByName(verifier.confirmed(rest)))
