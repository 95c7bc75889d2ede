"""A stream sink of its own: rows are staged by tasks and become visible by one commit per epoch.

Every task writes its rows to a file with a name of its own and reports it; the commit of an epoch
writes one log entry that names the files. Readers read the files of the log only. So a
task that fails or is repeated leaves nothing behind that can be read, an aborted epoch removes what
its tasks reported, and an epoch that is committed before changes nothing when it comes again.

    spark.dataSource.register(StagedRows)
    df.writeStream.format("staged_rows").option("path", folder).option("checkpointLocation", c).start()

Subclasses of `StagedRows` can stage rows elsewhere: see `stage` and `unstage`. Folders are what Arrow can
write (see sources.storage).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage)

from tidegauge.sources import storage


@dataclass
class Staged(WriterCommitMessage):
    file: str
    rows: int


def _log(path: str, epoch: str) -> str:
    return f"{path}/_log/{epoch}.json"


def _exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound


class Stage:
    """Writing a task's rows to a file, and the log."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.store, self.inner = storage.locate(self.path)

    def __getstate__(self):
        return self.path

    def __setstate__(self, path: str):
        self.__init__({"path": path})

    def stage(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        file, rows, writer = f"part-{uuid.uuid4().hex}.parquet", 0, None
        self.store.create_dir(self.inner, recursive=True)
        try:
            for batch in batches:
                if not len(batch):
                    continue
                if writer is None:
                    writer = pq.ParquetWriter(f"{self.inner}/{file}", batch.schema, filesystem=self.store)
                writer.write_batch(batch)
                rows += len(batch)
        except BaseException:
            if writer is not None:
                writer.close()
                self.store.delete_file(f"{self.inner}/{file}")
            raise
        if writer is not None:
            writer.close()
        return Staged(file, rows)

    def publish(self, messages: list[Staged | None], epoch: str) -> None:
        log = _log(self.inner, epoch)
        if _exists(self.store, log):
            self.unstage(messages)
            return
        files = sorted(m.file for m in messages if m is not None and m.rows)
        self.store.create_dir(f"{self.inner}/_log", recursive=True)
        # Readers see the entry whole or not at all.
        with self.store.open_output_stream(f"{log}.new") as out:
            out.write(json.dumps({"files": files}).encode())
        self.store.move(f"{log}.new", log)

    def unstage(self, messages: list[Staged | None]) -> None:
        for m in messages:
            if m is not None and m.rows and _exists(self.store, f"{self.inner}/{m.file}"):
                self.store.delete_file(f"{self.inner}/{m.file}")


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, stage: Stage):
        self.stage = stage

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.stage.stage(iterator)

    def commit(self, messages, batchId: int) -> None:
        self.stage.publish(messages, f"epoch-{batchId:020d}")

    def abort(self, messages, batchId: int) -> None:
        self.stage.unstage(messages)


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, stage: Stage):
        self.stage = stage

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.stage.stage(iterator)

    def commit(self, messages) -> None:
        self.stage.publish(messages, f"batch-{uuid.uuid4().hex}")

    def abort(self, messages) -> None:
        self.stage.unstage(messages)


class StagedRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "staged_rows"

    def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
        return StreamWriter(Stage(self.options))

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        return BatchWriter(Stage(self.options))


def read_staged(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all committed epochs."""
    store, inner = storage.locate(path.rstrip("/"))
    found = store.get_file_info(fs.FileSelector(f"{inner}/_log", allow_not_found=True))
    names = []
    for entry in found:
        if entry.path.endswith(".json"):
            with store.open_input_stream(entry.path) as file:
                names += json.loads(file.read())["files"]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{n}" for n in sorted(names)])


def sweep(path: str, older_than_ns: int) -> list[str]:
    """Delete files that no log entry names and that are older than a time in nanoseconds: left by
    tasks that were killed. Returns their names."""
    store, inner = storage.locate(path.rstrip("/"))
    known: set[str] = set()
    for entry in store.get_file_info(fs.FileSelector(f"{inner}/_log", allow_not_found=True)):
        with store.open_input_stream(entry.path) as file:
            known |= set(json.loads(file.read())["files"])
    gone = []
    for file, modified, _ in storage.listed(path, "part-*.parquet"):
        name = file.rsplit("/", 1)[-1]
        if name not in known and modified < older_than_ns:
            store.delete_file(file)
            gone.append(name)
    return gone
