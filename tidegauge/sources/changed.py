"""Lines of the files in a folder, again whenever a file changes.

A streaming data source whose offset is the state of the folder: path, modification time and length of
every file. A micro-batch holds the files that are new or changed since the last one, cut into ranges of
bytes that are read in parallel. With `growth` "all" a changed file gives all its lines again;
with "new" a file that only grew gives the lines added to it, and a line is given when its
end is written. Files that are deleted are ignored, one that goes before it was read gives nothing. A
restart goes on from the offsets of the checkpoint.

The driver lists the folder for every micro-batch and keeps one entry per file in the offset, so
use it for folders that are watched, not for archives. Register it once per session:

    spark.dataSource.register(ChangedLines)
    spark.readStream.format("changed_lines").option("pattern", "*.csv").load(folder)
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidegauge.sources import storage

SPLIT = 64 << 20
TAIL = 4096


@dataclass
class Range(InputPartition):
    path: str
    modified: int
    start: int
    stop: int
    limit: int


def ranges(path: str, modified: int, start: int, end: int, split: int = SPLIT) -> list[Range]:
    return [Range(path, modified, at, min(end, at + split), end) for at in range(start, end, split)]


def read_range(part: Range) -> Iterator[pa.RecordBatch]:
    store, inner = storage.locate(part.path)
    try:
        file = store.open_input_file(inner)
    except FileNotFoundError:
        return
    with file:
        for found in storage.lines(file, part.start, part.stop, min(part.limit, file.size())):
            values = [v.rstrip(b"\r").decode("utf-8", "replace") for v in found]
            n = len(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.string()), pa.array([part.path] * n, pa.string()),
                 pa.array([part.modified // 1000] * n, pa.int64()).cast(pa.timestamp("us", "UTC"))],
                names=["value", "file", "modified"])


def tail_checksum(file, length: int) -> int:
    """Checksum of the last bytes before a position, by which an added file is told from a new one."""
    file.seek(max(0, length - TAIL))
    return crc32(file.read(length - max(0, length - TAIL)))


class ChangedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changed_lines"

    def schema(self) -> str:
        return "value string, file string, modified timestamp"

    def streamReader(self, schema) -> ChangedReader:
        return ChangedReader(self.options)


class ChangedReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.pattern = options["path"], options.get("pattern", "*.csv")
        self.growth, self.split = options.get("growth", "all"), int(options.get("split", SPLIT))
        if self.growth not in ("all", "new"):
            raise ValueError("growth is all or new")

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        found = {}
        for path, modified, length in storage.listed(self.path, self.pattern):
            if self.growth == "all":
                found[path] = [modified, length]
                continue
            store, inner = storage.locate(path)
            try:
                with store.open_input_file(inner) as file:
                    length = storage.last_line_end(file, 0, min(length, file.size()))
                    found[path] = [modified, length, tail_checksum(file, length)]
            except FileNotFoundError:
                continue
        return {"files": found}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        before, out = start["files"], []
        for path, entry in sorted(end["files"].items()):
            known = before.get(path)
            if known != entry:
                first = self._grown_from(path, known, entry) if known is not None and self.growth == "new" else 0
                out += ranges(path, entry[0], first, entry[1], self.split)
        return out

    def _grown_from(self, path: str, known: list, entry: list) -> int:
        """Where new lines begin: at the old end if what was there before it is still there, else at 0.
        A file of the same lines with another time was written anew."""
        store, inner = storage.locate(path)
        try:
            with store.open_input_file(inner) as file:
                same = file.size() >= known[1] and tail_checksum(file, known[1]) == known[2]
                unfinished = file.size() > entry[1]
        except FileNotFoundError:
            return entry[1]
        return known[1] if same and (entry[1] > known[1] or unfinished) else 0

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(partition)
