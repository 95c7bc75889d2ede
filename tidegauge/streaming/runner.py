"""Starting, replaying and inspecting streaming queries."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidegauge.session import shared_dir

BATCH_INTERVAL = "5 seconds"
RESTARTS = 5
RESTART_DELAY = 10.0


def start(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, name: str,
          mode: str = "append", interval: str | None = BATCH_INTERVAL, available_now: bool = False) -> StreamingQuery:
    """One query writing through `write(batch, batch_id)`. The checkpoint makes a
    restart continue; `write` must give the same result when a batch is repeated."""
    writer = (df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
              .foreachBatch(write))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def supervise(begin: Callable[[], StreamingQuery], restarts: int = RESTARTS, delay: float = RESTART_DELAY,
              failed: Callable[[int, Exception], None] | None = None) -> int:
    """Run a query to its end and start it again after a failure, `restarts` times at most with `delay`
    seconds between; the failure after that is raised. `begin` starts the query with its
    checkpoint, so a restart goes on where it failed, and sinks that replace whole batches have each row
    once. Returns the number of restarts; `failed` is told of every failure."""
    done = 0
    while True:
        try:
            begin().awaitTermination()
            return done
        except StreamingQueryException as e:
            if failed is not None:
                failed(done, e)
            if done == restarts:
                raise
            done += 1
            time.sleep(delay)


def start_all(spark: SparkSession, starts: list[Callable[[], StreamingQuery]]) -> None:
    """Start several queries and wait until one stops; its error is raised."""
    for s in starts:
        s()
    spark.streams.awaitAnyTermination()


def replay(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None,
           path: str | None = None) -> DataFrame:
    """Run a stream over all data available now and return what it appended."""
    spark = df.sparkSession
    path = path or shared_dir(spark, name)
    q = (df.writeStream.queryName(name).outputMode(mode).format("parquet")
         .option("checkpointLocation", checkpoint or shared_dir(spark, f"{name}-checkpoint"))
         .option("path", path).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def deduplicated(df: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Drop re-delivered rows that come within `delay` of each other."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def observed(df: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Attach metrics, reported with the progress of every micro-batch."""
    return df.observe(name, *metrics)


class MetricsTable(StreamingQueryListener):
    """Writes the observed metrics (see `observed`) and the times of every micro-batch to a table: one
    JSON folder per run and batch, so that a repeated batch replaces itself. Listen with
    `spark.streams.addListener`, read with `read`."""

    SCHEMA = "query string, run string, batch long, time string, rows long, millis long, metric string, name string, value double"
    NAMES = ("query", "run", "batch", "time", "rows", "millis", "metric", "name", "value")

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        head = (p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.batchDuration)
        rows = [(*head, metric, name, None if value is None else float(value))
                for metric, row in p.observedMetrics.items() for name, value in row.asDict().items()]
        lines = [(json.dumps(dict(zip(self.NAMES, r))),) for r in rows or [(*head, None, None, None)]]
        self.spark.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite").text(
            f"{self.path}/run={p.runId}/part={p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).option("recursiveFileLookup", "true").json(self.path)


def read_state(spark: SparkSession, checkpoint: str, variable: str, operator: int = 0) -> DataFrame:
    """Current value of a state variable of a stopped or running query."""
    return (spark.read.format("statestore").option("operatorId", operator)
            .option("stateVarName", variable).load(checkpoint))
