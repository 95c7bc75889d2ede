"""Order-dependent operators over micro-batches without Python state.

Each micro-batch runs the batch operator, which divides hot keys into blocks, and meets
the result of all earlier batches through one state row per key. State is written as a
snapshot per batch number in a shared folder: a repeated batch starts from the same
snapshot and replaces the same output. Use these where a key may hold much of a batch
or the backlog is large; the stateful processors give lower latency.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators import rollup, taxi
from tidegauge.operators.rollup import Metric
from tidegauge.sinks import files

Write = Callable[[DataFrame, int], None]


class Snapshots:
    """State tables by batch number."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 3):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep

    def _numbers(self) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in files.children(self.spark, self.path)
                      if n.startswith("state=") and files.exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def before(self, batch_id: int) -> DataFrame | None:
        older = [n for n in self._numbers() if n < batch_id]
        return self.spark.read.parquet(f"{self.path}/state={older[-1]}") if older else None

    def save(self, state: DataFrame, batch_id: int) -> None:
        state.write.mode("overwrite").parquet(f"{self.path}/state={batch_id}")
        for n in [n for n in self._numbers() if n < batch_id][:-self.keep]:
            files.delete(self.spark, f"{self.path}/state={n}")


def _merged(metrics: list[Metric], sums: dict[str, str]) -> list[Column]:
    """Moments of a run that continues the stored one (s. = stored, r. = run)."""
    out = []
    for m in metrics:
        s, r = ({p: F.col(f"{side}.{p}_{m.suffix}") for p in ("n", "mean", "m2", "low", "high")} for side in ("s", "r"))
        n = s["n"] + r["n"]
        delta = r["mean"] - s["mean"]
        part = F.when(n > 0, r["n"] / n).otherwise(F.lit(0.0))
        out += [n.alias(f"n_{m.suffix}"), (s["mean"] + delta * part).alias(f"mean_{m.suffix}"),
                (s["m2"] + r["m2"] + delta * delta * s["n"] * part).alias(f"m2_{m.suffix}"),
                F.least(s["low"], r["low"]).alias(f"low_{m.suffix}"),
                F.greatest(s["high"], r["high"]).alias(f"high_{m.suffix}")]
    return out + [(F.col(f"s.{name}") + F.col(f"r.{name}")).alias(name) for name in sums]


def advance(runs: DataFrame, state: DataFrame, key: str, trigger: list[str], metrics: list[Metric],
            sums: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(runs closed by this batch, open runs after it). Only the first run of each key
    can continue the stored one, so the join has one row per key on both sides."""
    firsts = runs.groupBy(key).agg(F.min(F.struct(F.col("first_order").isNotNull(), "first_order")).alias("_f")).select(
        F.col(key).alias("_fk"), F.col("_f.first_order").alias("_fo"))
    is_first = F.col(key).eqNullSafe(F.col("_fk")) & F.col("first_order").eqNullSafe(F.col("_fo"))
    first = runs.join(firsts, is_first, "left_semi")
    rest = runs.join(firsts, is_first, "left_anti")
    pairs = first.withColumn("_here", F.lit(True)).alias("r").join(
        state.withColumn("_here", F.lit(True)).alias("s"), F.col(f"r.{key}").eqNullSafe(F.col(f"s.{key}")), "full_outer")
    same = F.col("r._here") & F.col("s._here")
    for t in trigger:
        same = same & F.col(f"r.{t}").eqNullSafe(F.col(f"s.{t}"))
    same = F.coalesce(same, F.lit(False))
    measured = {f"{p}_{m.suffix}" for m in metrics for p in ("n", "mean", "m2", "low", "high")} | set(sums)
    copied = [F.col(f"r.{c}") for c in runs.columns if c not in measured]
    columns = runs.columns
    stored = [F.col(f"s.{c}").alias(c) for c in columns]
    has_run, has_state = F.col("r._here").isNotNull(), F.col("s._here").isNotNull()
    continued = pairs.where(same).select(*copied, *_merged(metrics, sums)).select(*columns)
    fresh = pairs.where(has_run & ~same).select(*[F.col(f"r.{c}").alias(c) for c in columns])
    now = continued.unionByName(fresh).unionByName(rest)
    ended = pairs.where(has_run & has_state & ~same).select(*stored)
    untouched = pairs.where(~has_run).select(*stored)
    return (now.where(~F.col("is_open")).unionByName(ended),
            now.where("is_open").unionByName(untouched))


def change_rollup_batches(spark: SparkSession, root: str, key: str, order: str, trigger: list[str], labels: list[str],
                          metrics: list[Metric], sums: dict[str, str], write: Write) -> Write:
    """A foreachBatch function giving the runs of operators.rollup.change_rollup as they
    close. Batches must arrive in `order`."""
    snapshots = Snapshots(spark, f"{root}/open-runs")

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            moments = rollup.run_moments(batch, key, order, trigger, labels, metrics, sums)
            moments.write.mode("overwrite").parquet(f"{root}/runs={batch_id}")
            runs = spark.read.schema(moments.schema).parquet(f"{root}/runs={batch_id}")
        finally:
            batch.unpersist()
        state = snapshots.before(batch_id)
        closed, still_open = ((runs.where(~F.col("is_open")), runs.where("is_open")) if state is None
                              else advance(runs, state, key, trigger, metrics, sums))
        snapshots.save(still_open, batch_id)
        write(rollup.finish_moments(closed, key, labels, metrics, sums), batch_id)
        # The batch is written; what it was computed from is needed no more.
        files.delete(spark, f"{root}/runs={batch_id}")

    return run


def daily_change_batches(spark: SparkSession, root: str, write: Write) -> Write:
    return change_rollup_batches(spark, root, "wsid", "seq", ["day"], ["year", "month", "day"],
                                 rollup.CHANGE_DAILY_METRICS, {"precip": "one_hour_precip"}, write)


def monthly_change_batches(spark: SparkSession, root: str, write: Write) -> Write:
    """To be called with the output of `daily_change_batches` for the same batch."""
    return change_rollup_batches(spark, root, "wsid", "last_order", ["month"], ["year", "month"],
                                 rollup.CHANGE_MONTHLY_METRICS, {}, write)


def predict_batches(spark: SparkSession, root: str, write: Write, strict: bool = False) -> Write:
    """A foreachBatch function giving the predictions of operators.taxi.predict. The
    state is three sums per cell and direction."""
    snapshots = Snapshots(spark, f"{root}/regressions")

    def run(batch: DataFrame, batch_id: int) -> None:
        features = taxi.ride_features(batch, strict).persist()
        try:
            state = snapshots.before(batch_id)
            write(taxi.predict(features, initial=state), batch_id)
            sums = taxi.end_sums(features)
            if state is not None:
                sums = sums.unionByName(state).groupBy(*taxi.GROUP).agg(
                    *[F.sum(c).alias(c) for c in ("n", "sxy", "sxx")])
            snapshots.save(sums, batch_id)
        finally:
            features.unpersist()

    return run
