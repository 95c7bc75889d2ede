"""Time-series points: partitioned files, external stores, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidegauge.sinks import files

# Points per request to an external store.
WRITE_BATCH = 2000


def append_points(points: DataFrame, path: str, batch_id: int) -> None:
    """Points by measurement and day. Each batch has its own folder in a day, so a
    repeated batch replaces only itself."""
    (points.withColumn("date", F.to_date("time")).withColumn("batch", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("measurement", "date", "batch").parquet(path))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")


def expire(spark: SparkSession, path: str, now: dt.datetime, keep: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Remove day folders that lie entirely before now - keep; returns their names."""
    limit = (now - keep).date()
    dropped = []
    for m in files.children(spark, path):
        if not m.startswith("measurement="):
            continue
        for d in files.children(spark, f"{path}/{m}"):
            if d.startswith("date=") and dt.date.fromisoformat(d[5:]) < limit:
                files.delete(spark, f"{path}/{m}/{d}")
                dropped.append(f"{m}/{d}")
    return dropped


def write_external(df: DataFrame, connect: Callable[[], object], write: Callable[[object, list[Row]], None],
                   size: int = WRITE_BATCH) -> None:
    """Write rows to a store without a DataFrame writer: one connection per partition,
    `size` rows per call. Errors fail the task, and Spark repeats it, so `write` must
    be an upsert. The connection is closed through its `close`, if any."""
    def partition(rows: Iterator[Row]) -> None:
        client = connect()
        try:
            buffer: list[Row] = []
            for row in rows:
                buffer.append(row)
                if len(buffer) == size:
                    write(client, buffer)
                    buffer = []
            if buffer:
                write(client, buffer)
        finally:
            getattr(client, "close", lambda: None)()

    df.foreachPartition(partition)


class RowWriter:
    """Row-at-a-time stream sink for `writeStream.foreach`, for stores that accept
    nothing else. A partition and epoch already written can be skipped with `seen`."""

    def __init__(self, connect: Callable[[], object], write: Callable[[object, Row], None],
                 seen: Callable[[object, int, int], bool] | None = None):
        self.connect, self.write, self.seen = connect, write, seen

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.client = self.connect()
        return not (self.seen and self.seen(self.client, partition_id, epoch_id))

    def process(self, row: Row) -> None:
        self.write(self.client, row)

    def close(self, error: Exception | None) -> None:
        getattr(self.client, "close", lambda: None)()
