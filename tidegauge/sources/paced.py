"""Replay of text files by record: exactly N lines per micro-batch, again from the start at the end.

`build_index` cuts the files into pieces of some lines in a Spark job and stores where each piece
begins and how many lines there are before it. The streaming data source counts records: an offset is
the number of lines given out so far, which may be many times all lines. A micro-batch is N lines,
read from the pieces that hold them.

The number handed out last is also kept in a small file, by which a restarted query goes on with whole
micro-batches. The index is one row per piece on the driver; choose `every` so that pieces are
some megabytes.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidegauge.sources import storage
from tidegauge.sources.changed import Range, ranges

EVERY = 100_000


def build_index(spark: SparkSession, path: str, pattern: str, index: str, every: int = EVERY, split: int = 64 << 20) -> int:
    """Write the index of all lines of the files to the folder `index`; returns their number. Each task
    reads one range of bytes and notes the place of every `every`-th line in it."""
    parts = [r for f, modified, length in storage.listed(path, pattern) for r in ranges(f, modified, 0, length, split)]
    rows = spark.createDataFrame([(i, r.path, r.start, r.stop, r.limit) for i, r in enumerate(parts)],
                                 "part long, path string, start long, stop long, limit long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                store, inner = storage.locate(r["path"])
                places, n, at = [], 0, None
                with store.open_input_file(inner) as file:
                    for found in storage.lines(file, r["start"], r["stop"], r["limit"]):
                        if at is None:
                            at = _first_line(store, inner, r["start"], r["limit"])
                        for line in found:
                            if n % every == 0:
                                places.append(at)
                            n += 1
                            at += len(line) + 1
                counts = [min(every, n - i * every) for i in range(len(places))]
                ends = [*places[1:], at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["part"]] * len(places), pa.int64()), pa.array(range(len(places)), pa.int64()),
                     pa.array([r["path"]] * len(places), pa.string()), pa.array(places, pa.int64()),
                     pa.array(ends if places else [], pa.int64()), pa.array([r["limit"]] * len(places), pa.int64()),
                     pa.array(counts, pa.int64())],
                    names=["part", "piece", "path", "start", "stop", "limit", "lines"])

    schema = "part long, piece long, path string, start long, stop long, limit long, lines long"
    spread = rows.repartition(max(1, len(parts)), "part") if parts else rows
    spread.mapInArrow(run, schema).write.mode("overwrite").parquet(index)
    return spark.read.schema(schema).parquet(index).agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]


def _first_line(store, inner: str, start: int, limit: int) -> int:
    """Where the first line that begins at `start` or later begins."""
    if start == 0:
        return 0
    with store.open_input_file(inner) as file:
        file.seek(start - 1)
        at = start - 1
        while at < limit:
            block = file.read(min(storage.BLOCK, limit - at))
            found = block.find(b"\n")
            if found >= 0:
                return at + found + 1
            if not block:
                break
            at += len(block)
    return limit


@dataclass
class Piece(InputPartition):
    """Lines `skip` to `skip + take` of a piece of a file, from record `number` on."""

    path: str
    start: int
    stop: int
    limit: int
    skip: int
    take: int
    number: int


class PacedLines(DataSource):
    """Options: index (folder of `build_index`), rows (per micro-batch), state (file for the last number).
    Columns: number (of the record, from 0, never repeated) and value."""

    @classmethod
    def name(cls) -> str:
        return "paced_lines"

    def schema(self) -> str:
        return "number long, value string"

    def streamReader(self, schema) -> PacedReader:
        return PacedReader(self.options)


class PacedReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        import pyarrow.parquet as pq

        self.rows, self.state = int(options["rows"]), options["state"]
        store, inner = storage.locate(options["index"])
        found = pq.read_table(inner, filesystem=store).to_pylist()
        self.pieces = [(r["path"], r["start"], r["stop"], r["limit"], r["lines"])
                       for r in sorted(found, key=lambda r: (r["part"], r["piece"])) if r["lines"]]
        self.before = [0]
        for piece in self.pieces:
            self.before.append(self.before[-1] + piece[4])
        self.handed = None

    def __getstate__(self) -> dict:
        return {}  # reading a piece needs no index

    def initialOffset(self) -> dict:
        return {"number": 0}

    def latestOffset(self) -> dict:
        if not self.before[-1]:
            return {"number": 0}
        if self.handed is None:
            # After a restart the number handed out last comes again: its micro-batch may not be done.
            self.handed = self._read()
            if self.handed:
                return {"number": self.handed}
        self.handed += self.rows
        self._write(self.handed)
        return {"number": self.handed}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        out, at, total = [], start["number"], self.before[-1]
        self.handed = max(self.handed or 0, end["number"])
        while at < end["number"]:
            place = at % total
            i = bisect_right(self.before, place) - 1
            path, first, stop, limit, lines = self.pieces[i]
            skip = place - self.before[i]
            take = min(lines - skip, end["number"] - at)
            out.append(Piece(path, first, stop, limit, skip, take, at))
            at += take
        return out

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        store, inner = storage.locate(partition.path)
        skip, left, number = partition.skip, partition.take, partition.number
        with store.open_input_file(inner) as file:
            for found in storage.lines(file, partition.start, partition.stop, partition.limit):
                own = found[skip:skip + left]
                skip = max(0, skip - len(found))
                if own:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(range(number, number + len(own)), pa.int64()),
                         pa.array([v.rstrip(b"\r").decode("utf-8", "replace") for v in own], pa.string())],
                        names=["number", "value"])
                    number, left = number + len(own), left - len(own)
                if not left:
                    return

    def _read(self) -> int:
        store, inner = storage.locate(self.state)
        try:
            with store.open_input_stream(inner) as file:
                return json.loads(file.read())["number"]
        except FileNotFoundError:
            return 0

    def _write(self, number: int) -> None:
        store, inner = storage.locate(self.state)
        with store.open_output_stream(f"{inner}.new") as file:
            file.write(json.dumps({"number": number}).encode())
        store.move(f"{inner}.new", inner)


def paced(spark: SparkSession, index: str, rows: int, state: str) -> DataFrame:
    spark.dataSource.register(PacedLines)
    return spark.readStream.format("paced_lines").option("index", index).option("rows", rows).option("state", state).load()
