"""Time-series points, dashboard panels and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_points(df: DataFrame, measurement: str, tags: list[str] | dict[str, str], fields: list[str] | dict[str, str],
              as_of: Column | None = None) -> DataFrame:
    """Rows to (measurement, time, tags, fields). Time is the processing time, as a
    point is stamped when it is written; pass `as_of` for a replayable value."""
    tags = tags if isinstance(tags, dict) else {t: t for t in tags}
    fields = fields if isinstance(fields, dict) else {f: f for f in fields}
    tag_map = [x for name, c in tags.items() for x in (F.lit(name), F.col(c).cast("string"))]
    field_map = [x for name, c in fields.items() for x in (F.lit(name), F.col(c).cast("double"))]
    return df.select(F.lit(measurement).alias("measurement"),
                     (as_of if as_of is not None else F.current_timestamp()).alias("time"),
                     F.create_map(*tag_map).alias("tags"), F.create_map(*field_map).alias("fields"))


def raw_points(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    fields = {"year": "year", "month": "month", "day": "day", "hour": "hour",
              "temperature": "temperature", "dewpoint": "dewpoint", "pressure": "pressure",
              "windDirection": "wind_direction", "windSpeed": "wind_speed",
              "skyConditions": "sky_condition"}
    return to_points(raw, "raw_weather", {"station": "wsid"}, fields, as_of)


def rollup_points(rollup: DataFrame, grain: str, as_of: Column | None = None) -> DataFrame:
    """Temperature points of a `daily` or `monthly` rollup."""
    calendar = ["year", "month", "day"] if grain == "daily" else ["year", "month"]
    fields = {c: c for c in calendar}
    fields |= {s: f"{s}_temp" for s in ("high", "low", "mean", "variance", "stdev")}
    return to_points(rollup, f"{grain}_temp_weather", {"station": "wsid"}, fields, as_of)


def _latest(df: DataFrame, time: str, now) -> Column:
    """`now` as a column; by default the newest time of the data (one scalar)."""
    if now is not None:
        return now if isinstance(now, Column) else F.lit(now)
    return df.select(F.max(time)).scalar()


def panel(df: DataFrame, time: str, tags: list[str], fields: list[str], now=None,
          window: str = "1 HOUR") -> DataFrame:
    """Field series by tag over the last `window`, gaps left empty."""
    recent = F.col(time) >= _latest(df, time, now) - F.expr(f"INTERVAL {window}")
    return df.where(recent).select(time, *tags, *fields)


def panel_by_tag(df: DataFrame, time: str, tag: str, field: str, values: list, now=None,
                 window: str = "1 HOUR") -> DataFrame:
    """The panel with one column per listed tag value."""
    return (panel(df, time, [tag], [field], now, window).groupBy(time)
            .pivot(tag, values).agg(F.avg(field)))


def retain(df: DataFrame, time: str, now=None, keep: str = "1 DAY") -> DataFrame:
    """Rows not older than `keep` before now. On tables partitioned by date the
    comparison also prunes partitions; see sinks.points.expire for dropping files."""
    return df.where(F.col(time) >= _latest(df, time, now) - F.expr(f"INTERVAL {keep}"))
