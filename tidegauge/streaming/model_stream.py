"""Models that arrive as a stream, served by the micro-batches that follow.

Published models go to a store, one folder per micro-batch: their key, position and digest are joined with
the records (as-of), their bytes are read only for the digests that a micro-batch needs. A model that
no worker can compile is not stored, so the one before it stays in force. A repeated micro-batch
replaces its folder and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators import dispatch
from tidegauge.operators.asof import asof_join
from tidegauge.sinks import files

Write = Callable[[DataFrame, int], None]


def usable(models: DataFrame) -> DataFrame:
    """The rows whose model (model_type, data) compiles."""
    names = models.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, data = (batch.column(names.index(c)).to_pylist() for c in ("model_type", "data"))
            yield batch.filter(pa.array([dispatch.compiled(k, d) is not None for k, d in zip(kinds, data)], pa.bool_()))

    return models.mapInArrow(run, models.schema)


class ModelStore:
    """Published models by micro-batch: keys, order, model, digest, model_type, data."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: str):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), keys, order

    def _read(self, before: int) -> DataFrame | None:
        found = [n for n in files.children(self.spark, self.path)
                 if n.startswith("batch=") and int(n.split("=")[1]) <= before
                 and files.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        return self.spark.read.parquet(*[f"{self.path}/{n}" for n in sorted(found)]) if found else None

    def write_batch(self, models: DataFrame, batch_id: int) -> None:
        own = models.select(*self.keys, self.order, "model", F.sha2("data", 256).alias("digest"), "model_type", "data")
        usable(own).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def versions(self, batch_id: int) -> DataFrame | None:
        """What was published up to a micro-batch, without the bytes."""
        rows = self._read(batch_id)
        return None if rows is None else rows.select(*self.keys, self.order, "model", "digest")

    def models(self, batch_id: int, digests: DataFrame) -> DataFrame:
        return self._read(batch_id).select("digest", "model_type", "data").join(digests, "digest", "left_semi")


def with_models(records: DataFrame, models: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Records and published models (keys, order, model, model_type, data) as one stream, so that a
    micro-batch has both."""
    m = models.select(*keys, order, F.struct("model", "model_type", "data").alias("published"))
    return records.withColumn("published", F.lit(None).cast(m.schema["published"].dataType)).unionByName(
        m, allowMissingColumns=True)


def dispatch_batches(store: ModelStore, columns: list[str], write: Write, name: str = "score",
                     max_bytes: int = dispatch.MAX_BROADCAST_BYTES):
    """A foreachBatch function over `with_models`: stores the models of the micro-batch, and scores its
    records (`columns`) each by the newest model of its keys at its position. `write` gets the records
    with `model`, `digest` and the score."""
    keys, order = store.keys, store.order

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            models = batch.where("published is not null")
            store.write_batch(models.select(*keys, order, "published.*"), batch_id)
            records = batch.where("published is null").select(*columns)
            found = asof_join(records, store.versions(batch_id), order, order, ["model", "digest"], keys)
            asked = found.select("digest").where("digest is not null").distinct()
            write(dispatch.score_by_digest(found, store.models(batch_id, asked), "digest", name, max_bytes), batch_id)
        finally:
            batch.unpersist()

    return run
