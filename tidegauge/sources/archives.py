"""Zip archives entry by entry: the central directories are read first, then every entry by its range.

Entries are dealt to tasks by size, so one archive of many entries is read by many tasks, and an
archive may have any size. A compressed entry has no inner boundaries and is one task.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.sources import storage

TASK_BYTES = 64 << 20
BATCH_LINES = 10_000
_ENTRY = "path string, entry string, place long, header long, method int, packed long, size long"


def _whole_if_small(file):
    # The directory is looked for from the end, also before the start of a small file.
    return io.BytesIO(file.read()) if file.size() < 1 << 20 else file


def entries(archives: DataFrame) -> DataFrame:
    """The files in archives (column path): place in the archive, where they are and how packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                store, inner = storage.locate(path)
                with store.open_input_file(inner) as file, zipfile.ZipFile(_whole_if_small(file)) as z:
                    rows += [(path, e.filename, i, e.header_offset, e.compress_type, e.compress_size, e.file_size)
                             for i, e in enumerate(z.infolist()) if not e.is_dir()]
            names = ["path", "entry", "place", "header", "method", "packed", "size"]
            types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return archives.select("path").mapInArrow(run, _ENTRY)


def _unpacked(file, header: int, method: int, packed: int) -> Iterator[bytes]:
    """The bytes of an entry in blocks. Its own header is 30 bytes, a name and an extra field."""
    file.seek(header)
    head = file.read(30)
    name, extra = struct.unpack("<HH", head[26:30])
    file.seek(header + 30 + name + extra)
    if method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"entries packed by method {method} cannot be read")
    unpack = zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None
    while packed:
        block = file.read(min(packed, 1 << 20))
        if not block:
            raise EOFError("an archive ends inside an entry")
        packed -= len(block)
        while unpack and block:
            # Bounded output, whatever the compression.
            yield unpack.decompress(block, storage.BLOCK)
            block = unpack.unconsumed_tail
        if not unpack:
            yield block
    if unpack:
        yield unpack.flush()


def entry_lines(found: DataFrame) -> DataFrame:
    """value, file of every line of the entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(lines: list[bytes], path: str) -> pa.RecordBatch:
            values = [v.rstrip(b"\r").decode("utf-8", "replace") for v in lines]
            return pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array([path] * len(values), pa.string())],
                                              names=["value", "file"])

        for batch in batches:
            for e in batch.to_pylist():
                store, inner = storage.locate(e["path"])
                rest, held = b"", []
                with store.open_input_file(inner) as file:
                    for block in _unpacked(file, e["header"], e["method"], e["packed"]):
                        *lines, rest = (rest + block).split(b"\n")
                        held += lines
                        if len(held) >= BATCH_LINES:
                            yield batch_of(held, e["path"])
                            held = []
                if held or rest:
                    yield batch_of([*held, rest] if rest else held, e["path"])

    return found.mapInArrow(run, "value string, file string")


def read_archives(archives: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """value, file of all lines of all entries in archives (column path)."""
    found = entries(archives)
    n, total = found.agg(F.count("*"), F.coalesce(F.sum("packed"), F.lit(0))).first()
    if not n:
        return archives.sparkSession.createDataFrame([], "value string, file string")
    tasks = max(1, min(n, -(-total // task_bytes) + archives.sparkSession.sparkContext.defaultParallelism))
    return entry_lines(found.repartition(tasks, F.xxhash64("path", "place")))
