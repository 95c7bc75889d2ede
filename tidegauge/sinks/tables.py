"""Tables with last-write-wins rows per primary key, kept as parquet folders.

A micro-batch is written to its own folder, so a repeated batch replaces itself and
writers never touch files that are being read. Reading keeps the newest row per key.
`compact` folds finished batches into a snapshot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.ordered import latest_per_key
from tidegauge.operators.rollup import project_daily, project_monthly
from tidegauge.sinks import files


class BatchFolder:
    """Rows appended by micro-batch, one folder each, so that a repeated batch replaces itself."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self) -> DataFrame:
        """All rows of finished batches."""
        done = [f"{self.path}/{n}" for n in files.children(self.spark, self.path)
                if n.startswith("batch=") and files.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        return self.spark.read.parquet(*sorted(done))


class UpsertTable:
    def __init__(self, spark: SparkSession, path: str, pk: list[str], order: str | None = None,
                 partitions: list[str] | None = None, compact_every: int | None = 500):
        """A batch that is `compact_every` after the newest snapshot makes the next one; the folders
        it replaces go when the one after it is made. `order` decides between rows of one batch; without it a batch must have one
        row per key. `partitions` are columns of the key to prune by (year, month)."""
        self.spark, self.path, self.pk, self.order = spark, path.rstrip("/"), pk, order
        self.partitions = partitions or []
        self.compact_every = compact_every
        if not set(self.partitions) <= set(pk):
            raise ValueError("partition columns must be part of the primary key")

    def _numbers(self, prefix: str) -> list[int]:
        found = []
        for name in files.children(self.spark, self.path):
            if name.startswith(f"{prefix}=") and files.exists(self.spark, f"{self.path}/{name}/_SUCCESS"):
                found.append(int(name.split("=")[1]))
        return sorted(found)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*self.partitions).parquet(f"{self.path}/batch={batch_id}")
        if self.compact_every and batch_id - max(self._numbers("snapshot"), default=-1) >= self.compact_every:
            self.vacuum()
            self.compact()

    def _parts(self) -> list[DataFrame]:
        """The newest snapshot and, in one read with the batch number as a partition column, all
        batches after it."""
        snapshots = self._numbers("snapshot")
        base = snapshots[-1] if snapshots else -1
        parts = []
        if snapshots:
            parts.append(self.spark.read.parquet(f"{self.path}/snapshot={base}").withColumn("_batch", F.lit(base).cast("bigint")))
        newer = [f"{self.path}/batch={n}" for n in self._numbers("batch") if n > base]
        if newer:
            rows = self.spark.read.option("basePath", self.path).option("mergeSchema", "true").parquet(*newer)
            parts.append(rows.withColumn("_batch", F.col("batch").cast("bigint")).drop("batch"))
        return parts

    def read(self) -> DataFrame:
        """Current rows. Filters on key columns are pushed below the newest-row choice."""
        parts = self._parts()
        if not parts:
            raise FileNotFoundError(self.path)
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        order = [F.col("_batch").desc(), *([F.col(self.order).desc()] if self.order else [])]
        return latest_per_key(rows, self.pk, order).drop("_batch")

    def compact(self) -> int:
        """Fold all finished batches into one snapshot and return its number. Older
        folders stay readable until `vacuum`, for readers that already listed them."""
        last = max(self._numbers("batch"), default=-1)
        self.read().write.mode("overwrite").partitionBy(*self.partitions).parquet(f"{self.path}/snapshot={last}")
        return last

    def vacuum(self) -> None:
        snapshots = self._numbers("snapshot")
        if snapshots:
            for n in self._numbers("batch"):
                if n <= snapshots[-1]:
                    files.delete(self.spark, f"{self.path}/batch={n}")
            for n in snapshots[:-1]:
                files.delete(self.spark, f"{self.path}/snapshot={n}")


DAILY_TABLES = {"temp": "daily_temperature", "wind": "daily_windspeed", "pressure": "daily_pressure",
                "precip": "daily_precipitation"}
MONTHLY_TABLES = {"temp": "monthly_temperature", "wind": "monthly_windspeed", "pressure": "monthly_pressure",
                  "precip": "monthly_precipitation"}


def metric_tables(spark: SparkSession, root: str, grain: str) -> dict[str, UpsertTable]:
    names = DAILY_TABLES if grain == "daily" else MONTHLY_TABLES
    pk = ["wsid", "year", "month"] + (["day"] if grain == "daily" else [])
    return {m: UpsertTable(spark, f"{root}/{name}", pk, partitions=["year", "month"]) for m, name in names.items()}


def fan_out(spark: SparkSession, root: str, grain: str, also=None):
    """A foreachBatch function that writes one rollup micro-batch to its four metric
    tables. The batch is computed once; every table write is repeatable. `also` is
    called with the same batch (points, say)."""
    tables = metric_tables(spark, root, grain)
    project = project_daily if grain == "daily" else project_monthly

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for metric, table in tables.items():
                table.write_batch(project(batch, metric), batch_id)
            if also is not None:
                also(batch, batch_id)
        finally:
            batch.unpersist()

    return write
