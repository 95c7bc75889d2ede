"""Packing of documents into sequences of a fixed length, shortest pack first.

Documents are cut into whole sequences and one shorter rest. The rests are packed by their
length histogram: lengths are placed longest first, each into the pack with the most room, and
packs with equal contents are one pattern with a count. The histogram has at most one row per
length, so planning needs no more than that on the driver whatever the number of documents.
Documents then find their pack by their rank among the rests of their length.

Nulls: a null text is an empty one; a null id stays null. Repeated rows are packed like any
others. An empty table gives no rows. Other columns of the documents are not carried, so their
names do not matter. Very long texts become many pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.encoding import encoder
from tidegauge.llm.tables import lean, stored, text_of

END_ID = 1


@dataclass(frozen=True)
class Slot:
    """`packs` packs of one pattern, numbered from `first_pack`, take `each` pieces of `length`
    one after another from `offset`; their pieces have the ranks from `first_rank`."""

    length: int
    first_rank: int
    first_pack: int
    packs: int
    each: int
    offset: int


def plan_packs(histogram: dict[int, int], capacity: int) -> tuple[list[Slot], int]:
    """Slots for all pieces, and the number of packs. Packs of a pattern have consecutive
    numbers; a pattern is divided when only some of its packs get another piece."""
    slots: list[Slot] = []
    # (used length, first pack, packs); the smallest used length has the most room.
    open_packs: list[tuple[int, int, int]] = []
    next_pack = 0
    for length in sorted(histogram, reverse=True):
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} does not fit into {capacity}")
        left, rank = histogram[length], 0
        while left:
            if not open_packs or open_packs[0][0] + length > capacity:
                each = capacity // length
                if left >= each:
                    packs, used = left // each, each * length
                else:
                    packs, each, used = 1, left, left * length
                slots.append(Slot(length, rank, next_pack, packs, each, 0))
                heapq.heappush(open_packs, (used, next_pack, packs))
                next_pack += packs
            else:
                used, first, packs = heapq.heappop(open_packs)
                room = (capacity - used) // length
                # As many as it takes to use as much as the next pattern does.
                ahead = open_packs[0][0] - used if open_packs else capacity
                each = max(1, min(room, ahead // length, left // packs))
                if left < packs:
                    heapq.heappush(open_packs, (used, first + left, packs - left))
                    packs = left
                slots.append(Slot(length, rank, first, packs, each, used))
                heapq.heappush(open_packs, (used + each * length, first, packs))
            rank += packs * each
            left -= packs * each
    return slots, next_pack


def encode_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_column: str = "doc_id",
                  text_column: str = "text", end_id: int = END_ID) -> DataFrame:
    """Pieces of at most `capacity` ids of every document: doc_id, start (ids of the document
    before it), length, doc_tokens, ids (little-endian unsigned 32 bit). `end_id` follows the
    ids of each text, so an empty text has one piece of one id."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(tokenizer) as own:
            for batch in batches:
                for i, j, ids, offsets in own.steps(batch.column(1)):
                    n = np.diff(offsets) + 1
                    ends = np.cumsum(n)
                    data = np.full(int(ends[-1]), end_id, np.uint32)
                    body = np.ones(len(data), bool)
                    body[ends - 1] = False
                    data[body] = ids
                    pieces = -(-n // capacity)
                    row = np.repeat(np.arange(len(n)), pieces)
                    start = (np.arange(len(row)) - (np.cumsum(pieces) - pieces)[row]) * capacity
                    length = np.minimum(capacity, n[row] - start)
                    at = np.concatenate([[0], np.cumsum(length)]).astype(np.int32) * 4
                    packed = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(at),
                                                                           pa.py_buffer(data.astype("<u4"))])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, j - i).take(pa.array(row)), pa.array(start), pa.array(length),
                         pa.array(n[row]), packed], names=["doc_id", "start", "length", "doc_tokens", "ids"])

    kind = dict(docs.dtypes)[id_column]
    return docs.select(F.col(id_column), text_of(text_column).alias("text")).mapInArrow(
        run, f"doc_id {kind}, start long, length long, doc_tokens long, ids binary")


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """`pieces` with sequence_id and offset. Any table with a column `length` from 1 to
    `capacity`; it must not have columns named sequence_id, offset, _part, _rank or _base.
    Written below the shared folder. Offsets of a sequence have no gaps."""
    spark = pieces.sparkSession
    columns = pieces.columns

    @lean
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            first = np.searchsorted(ordered, ordered)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - first + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), part)), pa.array(rank)],
                                             names=[*columns, "_part", "_rank"])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in pieces.dtypes), "_part long", "_rank long"])
    # Stored before it is numbered, so that no task needs two Python workers at once.
    numbered = stored(stored(pieces, "pieces").mapInArrow(number, schema), "pieces")

    counts = numbered.groupBy("_part", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # At most `capacity` rows.
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_n")).collect()}
    slots, _ = plan_packs(histogram, capacity)
    # Slots come in the order of length (falling) and rank. Their number depends on the
    # capacity, not on the rows: each length divides at most one pattern and adds two.
    table = spark.sparkContext.broadcast(np.array(
        [[-s.length, s.first_rank, s.first_pack, s.packs, s.each, s.offset] for s in slots], np.int64).reshape(-1, 6))

    @lean
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        falling, first_rank, first_pack, packs, each, offset = table.value.T
        first_slot = np.searchsorted(falling, -np.arange(capacity + 1))
        # A length's slots and ranks in one increasing number, to find both at once.
        span = int(first_rank.max(initial=0)) + 1
        key = (falling + capacity) * span + first_rank
        assert len(first_slot)
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy() + batch.column("_base").to_numpy()
            slot = np.searchsorted(key, (capacity - length) * span + np.minimum(rank, span - 1), side="right") - 1
            inside = rank - first_rank[slot]
            sequence = first_pack[slot] + inside // each[slot]
            start = offset[slot] + inside % each[slot] * length
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(start)],
                                             names=[*columns, "sequence_id", "offset"])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in pieces.dtypes), "sequence_id long", "offset long"])
    return numbered.join(bases, ["_part", "length"]).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_column: str = "doc_id",
                   text_column: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their place: doc_id, start, length, doc_tokens, ids,
    ids_crc32, sequence_id, offset. Without `with_ids` only the checksum of the ids is kept."""
    pieces = encode_pieces(docs, tokenizer, capacity, id_column, text_column)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids"))
    return pack(pieces if with_ids else pieces.drop("ids"), capacity)


def sequences(packed: DataFrame, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, ids (array, padded to `capacity`),
    doc_ids and starts of the pieces in order. A sequence has at most `capacity` pieces."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for pieces in batch.column("pieces").to_pylist():
                ids = np.concatenate([np.frombuffer(p["ids"], "<u4") for p in pieces])
                rows.append((len(ids), np.pad(ids, (0, capacity - len(ids)), constant_values=pad_id).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.list_(pa.int64())), batch.column("doc_ids"),
                 batch.column("starts")], names=["sequence_id", "n_tokens", "ids", "doc_ids", "starts"])

    grouped = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "ids"))).alias("pieces")).select(
        "sequence_id", "pieces", F.col("pieces.doc_id").alias("doc_ids"), F.col("pieces.start").alias("starts"))
    kind = dict(packed.dtypes)["doc_id"]
    return grouped.mapInArrow(run, f"sequence_id long, n_tokens long, ids array<long>, doc_ids array<{kind}>, "
                                   "starts array<long>")
