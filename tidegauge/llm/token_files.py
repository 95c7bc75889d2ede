"""Token ids in binary files, packed at a fixed width.

The table is sorted by document id and written as shards. A shard is one file of at most about
`shard_ids` ids (a longer document makes a longer shard), little-endian throughout:

    magic "TGIDS1\\0\\0", then 8 int64: version, bits, block_ids, n_docs, n_ids, n_blocks,
    part (number of the writing task), before (ids of the part before this shard)
    n_docs int64 document ids, n_docs uint8 (1: the id is null), padded to 8 bytes
    n_docs + 1 int64 offsets of the documents in the shard's ids
    n_blocks + 1 int64 byte offsets of the blocks in the payload
    payload: blocks of `block_ids` ids, each id in `bits` bits, lowest bit first
    one line feed, which the writer adds

`bits` is the least width that holds the vocabulary. Any range of ids is read from its own
blocks, and a block is unpacked by numpy at once. Files go through Spark's own writer and
reader, so they may be in any store that Spark reaches.

Nulls: a null text has the end id only; null document ids come first. Repeated rows are written
each. An empty table writes no shard and gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.encoding import encoder, vocabulary_size
from tidegauge.llm.tables import lean, text_of

MAGIC = b"TGIDS1\0\0"
HEADER = 8 + 8 * 8
BLOCK_IDS = 8192
SHARD_IDS = 1 << 21


def bits_for(vocabulary: int) -> int:
    return max(1, (max(1, vocabulary) - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = (ids[:, None].astype(np.uint64) >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(wide.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: memoryview | bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little")
    return flat.reshape(count, bits).astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


def make_shard(doc_ids: list[int | None], ids: list[np.ndarray], bits: int, part: int, before: int,
               block_ids: int = BLOCK_IDS) -> bytes:
    flat = np.concatenate(ids)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    blocks = [pack_bits(flat[i:i + block_ids], bits) for i in range(0, len(flat), block_ids)]
    null = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([
        MAGIC, np.array([1, bits, block_ids, len(doc_ids), len(flat), len(blocks), part, before], "<i8").tobytes(),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        null.tobytes() + b"\0" * (-len(null) % 8), offsets.astype("<i8").tobytes(),
        np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<i8").tobytes(), *blocks])


class Shard:
    """Random access to the bytes of one shard."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a shard of token ids")
        (_, self.bits, self.block_ids, n_docs, self.n_ids, n_blocks, self.part, self.before) = (
            int(x) for x in np.frombuffer(data, "<i8", 8, 8))
        at = HEADER
        doc_ids = np.frombuffer(data, "<i8", n_docs, at)
        null = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs)
        self.doc_ids = pa.array(doc_ids, mask=null.astype(bool))
        at += 8 * n_docs + n_docs + -n_docs % 8
        self.offsets = np.frombuffer(data, "<i8", n_docs + 1, at)
        at += 8 * (n_docs + 1)
        self.blocks = np.frombuffer(data, "<i8", n_blocks + 1, at)
        self.payload = memoryview(data)[at + 8 * (n_blocks + 1):]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from start to stop, exclusive; only their blocks are unpacked."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        parts = [unpack_bits(self.payload[self.blocks[b]:self.blocks[b + 1]],
                             min(self.block_ids, self.n_ids - b * self.block_ids), self.bits)
                 for b in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block_ids:stop - first * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.offsets[i]), int(self.offsets[i + 1]))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_column: str = "doc_id",
                      text_column: str = "text", shard_ids: int = SHARD_IDS, partitions: int | None = None) -> None:
    """Write shards of all documents in ascending order of their integer ids to the folder `path`.
    Parts follow each other in the order of ids, and so do the shards of a part."""
    spark = docs.sparkSession
    bits = bits_for(max(vocabulary_size(tokenizer), end_id + 1))
    if dict(docs.dtypes)[id_column] not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError("document ids are integers")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"),
                       F.monotonically_increasing_id().alias("_row"))
    # The row number keeps equal ids apart, so many rows of one id are several tasks' work.
    order = [F.col("doc_id").asc_nulls_first(), F.col("_row")]
    rows = (rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []
        held = before = 0

        def close() -> pa.RecordBatch:
            nonlocal held, before
            shard = make_shard(doc_ids, ids, bits, part, before)
            before += held
            held = 0
            doc_ids.clear()
            ids.clear()
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.binary())], names=["shard"])

        with encoder(tokenizer, keep=True) as own:
            for batch in batches:
                for i, j, flat, offsets in own.steps(batch.column(1)):
                    for doc_id, start, stop in zip(batch.column(0).slice(i, j - i).to_pylist(), offsets[:-1], offsets[1:]):
                        if held and held + stop - start + 1 > shard_ids:
                            yield close()
                        doc_ids.append(doc_id)
                        ids.append(np.append(flat[start:stop], np.uint32(end_id)))
                        held += int(stop - start) + 1
        if doc_ids:
            yield close()

    shards = rows.sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, "shard binary")
    # The text writer puts the bytes of a value into the file as they are; one value per file.
    shards.select(F.col("shard").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32
    bit) of every document in the files."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                shard = Shard(data.as_py())
                n = len(shard.doc_ids)
                # Some million ids at a time.
                step = max(1, n * SHARD_IDS // max(1, shard.n_ids))
                for i in range(0, n, step):
                    offsets = shard.offsets[i:i + step + 1]
                    ids = shard.ids(int(offsets[0]), int(offsets[-1]))
                    own = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
                        None, pa.py_buffer((offsets - offsets[0]).astype(np.int64) * 4), pa.py_buffer(ids.astype("<u4"))])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), shard.part)), shard.doc_ids[i:i + step],
                         pa.array(shard.before + offsets[:-1]), pa.array(np.diff(offsets)), own.cast(pa.binary())],
                        names=["_part", "doc_id", "_start", "n_tokens", "ids"])

    files = _files(spark, path).select("content")
    docs = files.mapInArrow(run, "_part long, doc_id long, _start long, n_tokens long, ids binary")
    # One row of two numbers per writing task, so small that it is broadcast; the ids stay in place.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = part_sizes(spark, path).withColumn("_base", F.coalesce(F.sum("_ids").over(before), F.lit(0)))
    return docs.join(F.broadcast(parts.select("_part", "_base")), "_part").select(
        "doc_id", (F.col("_base") + F.col("_start")).alias("start"), "n_tokens", "ids")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where(F.col("length") > HEADER)


def part_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Ids of each part, from the headers of its shards."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head = [np.frombuffer(data.as_buffer(), "<i8", 8, 8) for data in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([int(h[6]) for h in head], pa.int64()),
                                              pa.array([int(h[4]) for h in head], pa.int64())], names=["_part", "_n"])

    heads = _files(spark, path).select(F.substring("content", 1, HEADER).alias("content"))
    return heads.mapInArrow(run, "_part long, _n long").groupBy("_part").agg(F.sum("_n").alias("_ids"))


def checksum(docs: DataFrame) -> DataFrame:
    """ids_crc32 in place of the ids."""
    return docs.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
