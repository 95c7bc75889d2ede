"""Attaching the newest model or setting to a stream of records."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidegauge.operators.asof import asof_join
from tidegauge.streaming import reorder


class CurrentVersion(StatefulProcessor):
    """Keeps one version (a string or a whole number) per key and gives it to the records that follow it."""

    def __init__(self, order: str, payload: str, output: list[str], kind: str = "string"):
        self.order, self.payload, self.output, self.kind = order, payload, output, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", f"version {self.kind}")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        b = pd.concat(list(rows)).sort_values([self.order, "is_version"], ascending=[True, False], kind="stable")
        before = self.current.get()[0] if self.current.exists() else None
        seen = b[self.payload].astype(object).where(b["is_version"].to_numpy(dtype=bool)).ffill()
        if before is not None:
            seen = seen.fillna(before)
        newest = seen.iloc[-1]
        if newest is not None and not pd.isna(newest):
            self.current.update((newest if self.kind == "string" else int(newest),))
        out = b.assign(**{self.payload: seen.where(seen.notna(), None).astype(object)})
        yield out.loc[~b["is_version"].to_numpy(dtype=bool), self.output].astype({
            c: object for c in self.output if not pd.api.types.is_numeric_dtype(out[c])})

    def close(self) -> None:
        pass


def keyed_versions_stream(data: DataFrame, versions: DataFrame, key: str, order: str, payload: str,
                          time: str | None = None, delay_ms: int = reorder.DELAY_MS) -> DataFrame:
    """Stateful join of two streams per key. `versions` has key, order and payload (a string or a whole
    number). With the event time `time` in both, rows may come out of order (see reorder)."""
    kind = versions.schema[payload].dataType.simpleString()
    if kind not in ("string", "int", "bigint"):
        raise TypeError(f"{payload} is {kind}; need a string or a whole number")
    names = [reorder.safe(c) for c in data.columns]
    d = data.toDF(*names).withColumn(payload, F.lit(None).cast(kind)).withColumn("is_version", F.lit(False))
    v = versions.select(key, order, payload, *([time] if time else [])).withColumn("is_version", F.lit(True))
    both = d.unionByName(v, allowMissingColumns=True)
    output = [*names, payload]
    schema = T.StructType([*[T.StructField(n, f.dataType) for n, f in zip(names, data.schema)], versions.schema[payload]])
    joined = reorder.run(both, [key], CurrentVersion(order, payload, output, kind), schema, time, delay_ms)
    return joined.toDF(*data.columns, payload)


def control_stream(requests: DataFrame, controls: DataFrame, key: str, order: str, setting: str, default: int = 100,
                   time: str | None = None, delay_ms: int = reorder.DELAY_MS) -> DataFrame:
    """Streaming form of operators.asof.control_asof: requests with the setting in force for their
    key, from a stream of settings (key, order, setting). Absent or non-positive means `default`."""
    out = keyed_versions_stream(requests, controls, key, order, setting, time, delay_ms)
    return out.withColumn(setting, F.when(F.col(setting) > 0, F.col(setting)).otherwise(F.lit(default)).cast("bigint"))


def per_batch_asof(read_versions: Callable[[SparkSession], DataFrame], order: str, version_order: str,
                   payload: list[str], keys: list[str], write: Callable[[DataFrame, int], None]):
    """A foreachBatch function that joins each micro-batch with the version table as it
    is then. The stream itself is not shuffled while versions are few, so this is the
    form for a global model or a hot key."""
    def run(batch: DataFrame, batch_id: int) -> None:
        versions = read_versions(batch.sparkSession)
        write(asof_join(batch, versions, order, version_order, payload, keys), batch_id)
    return run
