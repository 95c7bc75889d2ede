"""Calendar rollups, change-triggered rollups and per-metric projections."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators import blocks
from tidegauge.operators.blocks import BLOCK, BlockLayout


@dataclass(frozen=True)
class Metric:
    """A measured column and the suffix of its five statistics. `above` ignores
    values that are not greater (used to skip missing pressures stored as 0)."""

    suffix: str
    column: str
    above: float | None = None

    def value(self) -> Column:
        c = F.col(self.column)
        return c if self.above is None else F.when(c > F.lit(self.above), c)


DAILY_METRICS = [Metric("temp", "temperature"), Metric("wind", "wind_speed"), Metric("pressure", "pressure")]
MONTHLY_METRICS = [*DAILY_METRICS, Metric("precip", "one_hour_precip")]
CHANGE_DAILY_METRICS = [Metric("temp", "temperature"), Metric("wind", "wind_speed"),
                        Metric("pressure", "pressure", above=1.0)]
CHANGE_MONTHLY_METRICS = [Metric("temp", "mean_temp"), Metric("wind", "mean_wind"),
                          Metric("pressure", "mean_pressure"), Metric("precip", "precip")]


def five_stats(metric: Metric, population: bool) -> list[Column]:
    """high, low, mean, variance, stdev as mergeable built-in aggregates."""
    v, s = metric.value(), metric.suffix
    var, dev = (F.var_pop, F.stddev_pop) if population else (F.var_samp, F.stddev_samp)
    return [F.max(v).alias(f"high_{s}"), F.min(v).alias(f"low_{s}"), F.avg(v).alias(f"mean_{s}"),
            var(v).alias(f"variance_{s}"), dev(v).alias(f"stdev_{s}")]


def calendar_rollup(raw: DataFrame, keys: list[Column | str], metrics: list[Metric],
                    sums: dict[str, str] | None = None) -> DataFrame:
    """Sample statistics per key. One shuffle of partial aggregates, in batch and
    in streaming (update mode) alike."""
    aggs = [a for m in metrics for a in five_stats(m, population=False)]
    aggs += [F.sum(src).alias(name) for name, src in (sums or {}).items()]
    return raw.groupBy(*keys).agg(*aggs)


def daily_calendar(raw: DataFrame) -> DataFrame:
    return calendar_rollup(raw, ["wsid", "year", "month", "day"], DAILY_METRICS,
                           {"precip": "one_hour_precip"})


def monthly_calendar(raw: DataFrame) -> DataFrame:
    return calendar_rollup(raw, ["wsid", "year", "month"], MONTHLY_METRICS)


def daily_window(raw: DataFrame, time: str, delay: str | None = None) -> DataFrame:
    """The daily rollup by event-time window, so that a watermark can bound the
    state of the streaming form."""
    if delay:
        raw = raw.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return calendar_rollup(raw, ["wsid", F.window(F.col(time), "1 day")], DAILY_METRICS,
                           {"precip": "one_hour_precip"})


def stat_counter(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Count, sum, mean, extremes and both kinds of variance of one column."""
    c = F.col(column)
    return df.groupBy(*keys).agg(
        F.count(c).alias("n"), F.sum(c).alias("total"), F.avg(c).alias("mean"),
        F.max(c).alias("high"), F.min(c).alias("low"),
        F.var_pop(c).alias("variance"), F.var_samp(c).alias("sample_variance"),
        F.stddev_pop(c).alias("stdev"), F.stddev_samp(c).alias("sample_stdev"))


def change_rollup(df: DataFrame, key: str, order: str, trigger: list[str], labels: list[str],
                  metrics: list[Metric], sums: dict[str, str],
                  layout: BlockLayout | None = None) -> DataFrame:
    """Statistics of each closed run of equal `trigger` values, per key in `order`.

    A run closes when the next record of its key has another trigger value; the
    last, still open run of each key is left out. Statistics are of the population.
    `labels` are numeric columns taken from the run's last record, which also gives
    `last_order` for chaining. `order` must be unique within a key; records without one
    come first, by their trigger. NULL is a key and a trigger value like any other.

    Runs are numbered inside blocks of the order axis. A run that crosses blocks
    gets the number it has in the block where it starts, found from one summary row
    per (key, block), so neither a hot key nor a very long run is in one task.
    """
    rows = _numbered(df, key, order, trigger, layout).where(~F.col("_open"))
    aggs = [F.max_by(c, _place(order, trigger)).alias(c) for c in labels]
    aggs += [a for m in metrics for a in five_stats(m, population=True)]
    aggs += [F.sum(src).alias(name) for name, src in sums.items()]
    closed = rows.groupBy(key, "_head", "_id").agg(*aggs, F.max(order).alias("last_order"))
    return closed.drop("_head", "_id")


def run_moments(df: DataFrame, key: str, order: str, trigger: list[str], labels: list[str],
                metrics: list[Metric], sums: dict[str, str], layout: BlockLayout | None = None) -> DataFrame:
    """All runs, the open ones too, with mergeable moments (n, mean, m2, low, high) per
    metric instead of statistics; see streaming.incremental."""
    aggs = [F.max_by(c, _place(order, trigger)).alias(c) for c in dict.fromkeys([*trigger, *labels])]
    for m in metrics:
        v, s = m.value(), m.suffix
        n = F.count(v)
        aggs += [n.cast("double").alias(f"n_{s}"), F.coalesce(F.avg(v), F.lit(0.0)).alias(f"mean_{s}"),
                 F.coalesce(F.var_pop(v) * n, F.lit(0.0)).alias(f"m2_{s}"),
                 F.min(v).alias(f"low_{s}"), F.max(v).alias(f"high_{s}")]
    aggs += [F.sum(src).alias(name) for name, src in sums.items()]
    rows = _numbered(df, key, order, trigger, layout)
    return rows.groupBy(key, "_head", "_id").agg(
        *aggs, F.min(order).alias("first_order"), F.max(order).alias("last_order"),
        F.max("_open").alias("is_open")).drop("_head", "_id")


def finish_moments(runs: DataFrame, key: str, labels: list[str], metrics: list[Metric], sums: dict[str, str]) -> DataFrame:
    """Statistics of runs given as moments, in the columns of change_rollup."""
    out = [key, *labels]
    for m in metrics:
        s = m.suffix
        n = F.col(f"n_{s}")
        var = F.when(n > 0, F.greatest(F.col(f"m2_{s}"), F.lit(0.0)) / n)
        out += [F.col(f"high_{s}"), F.col(f"low_{s}"), F.when(n > 0, F.col(f"mean_{s}")).alias(f"mean_{s}"),
                var.alias(f"variance_{s}"), F.sqrt(var).alias(f"stdev_{s}")]
    return runs.select(*out, *sums, "last_order")


def _place(order: str, trigger: list[str]) -> Column:
    """Sorts like (order, trigger) with NULLs first, and is never NULL itself."""
    return F.struct(F.col(order).isNotNull(), F.col(order), *trigger)


def _numbered(df: DataFrame, key: str, order: str, trigger: list[str], layout: BlockLayout | None) -> DataFrame:
    """Rows with the identity of their run (`_head`, `_id`) and whether it is open."""
    layout = layout or blocks.plan_blocks(df, order)
    rows = layout.assign(df, order)
    # A struct is not NULL, so NULL triggers compare like values; no next record is NULL.
    trig = F.struct(*trigger)
    ordered = Window.partitionBy(key, BLOCK).orderBy(_place(order, trigger).desc())
    rows = (rows.withColumn("_next", F.lag(trig).over(ordered))
            .withColumn("_closes", F.when(F.col("_next") != trig, 1).otherwise(0))
            # Numbered from the end: run 0 is the block's last one.
            .withColumn("_run", F.sum("_closes").over(
                ordered.rowsBetween(Window.unboundedPreceding, 0))))
    if layout.single:
        return rows.withColumns({"_head": F.col(BLOCK), "_id": F.col("_run"), "_open": F.col("_run") == 0})
    rows = (rows.withColumn("_first_run", F.max("_run").over(Window.partitionBy(key, BLOCK)))
            .transform(blocks.joined, _run_starts(layout.assign(df, order), key, order, trigger), [key, BLOCK]))
    joins = (F.col("_run") == F.col("_first_run")) & F.col("_continues")
    rows = rows.withColumns({"_head": F.when(joins, F.col("_first_head")).otherwise(F.col(BLOCK)),
                             "_id": F.when(joins, F.lit(0)).otherwise(F.col("_run"))})
    return rows.withColumn("_open", (F.col("_id") == 0) & (F.col("_head") == F.col("_open_head")))


def _run_starts(rows: DataFrame, key: str, order: str, trigger: list[str]) -> DataFrame:
    """Per (key, block): does its first run continue the previous block's last one,
    in which block does that run start, and in which does the key's open run."""
    trig, place = F.struct(*trigger), _place(order, trigger)
    per_block = rows.groupBy(key, BLOCK).agg(
        F.min_by(trig, place).alias("_in"), F.max_by(trig, place).alias("_out"),
        (F.min(trig) == F.max(trig)).alias("_uniform"))
    across = Window.partitionBy(key).orderBy(BLOCK)
    chained = (
        per_block
        .withColumn("_continues", F.coalesce(F.lag("_out").over(across) == F.col("_in"), F.lit(False)))
        .withColumn("_last_head", F.last(
            F.when(~(F.col("_uniform") & F.col("_continues")), F.col(BLOCK)), ignorenulls=True
        ).over(blocks.up_to([key]))))
    return (chained
            .withColumn("_first_head", F.lag("_last_head").over(across))
            .withColumn("_open_head", F.max("_last_head").over(Window.partitionBy(key)))
            .select(key, BLOCK, "_continues", "_first_head", "_open_head"))


def daily_change(raw: DataFrame, order: str = "seq", trigger: list[str] | None = None,
                 layout: BlockLayout | None = None) -> DataFrame:
    """Change-triggered daily rollup. The default trigger compares the day number
    only; pass ["year", "month", "day"] to compare dates."""
    return change_rollup(raw, "wsid", order, trigger or ["day"], ["year", "month", "day"],
                         CHANGE_DAILY_METRICS, {"precip": "one_hour_precip"}, layout)


def monthly_change(daily: DataFrame, order: str = "last_order", trigger: list[str] | None = None,
                   layout: BlockLayout | None = None) -> DataFrame:
    """Change-triggered monthly rollup of daily means and precipitation sums. `daily` is
    read several times: pass a stored table (see session.materialize)."""
    carrier = daily.select("wsid", "year", "month", F.col(order).alias("seq"), "mean_temp",
                           "mean_wind", "mean_pressure", "precip")
    return change_rollup(carrier, "wsid", "seq", trigger or ["month"], ["year", "month"],
                         CHANGE_MONTHLY_METRICS, {}, layout)


def project_metric(rollup: DataFrame, suffix: str, keys: list[str]) -> DataFrame:
    """One metric of a rollup as high, low, mean, variance, stdev."""
    return rollup.select(*keys, *[F.col(f"{s}_{suffix}").alias(s)
                                  for s in ("high", "low", "mean", "variance", "stdev")])


def project_daily(daily: DataFrame, metric: str) -> DataFrame:
    keys = ["wsid", "year", "month", "day"]
    if metric == "precip":
        return daily.select(*keys, F.col("precip").alias("precipitation"))
    return project_metric(daily, metric, keys)


def project_monthly(monthly: DataFrame, metric: str) -> DataFrame:
    return project_metric(monthly, metric, ["wsid", "year", "month"])
