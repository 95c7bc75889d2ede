"""Text and JSON records to typed columns.

Parsers never fail the job on a bad record: each returns a frame with the typed
columns and a boolean `is_valid`; `split_bad` separates the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field order and types of the comma-separated weather record.
WEATHER_CSV = [
    ("wsid", "string"), ("year", "int"), ("month", "int"), ("day", "int"), ("hour", "int"),
    ("temperature", "double"), ("dewpoint", "double"), ("pressure", "double"),
    ("wind_direction", "int"), ("wind_speed", "double"), ("sky_condition", "int"),
    ("one_hour_precip", "double"), ("six_hour_precip", "double"),
]
# All columns of a weather record, in stored order.
WEATHER_COLUMNS = [
    "wsid", "year", "month", "day", "hour", "temperature", "dewpoint", "pressure",
    "wind_direction", "wind_speed", "sky_condition", "sky_condition_text",
    "one_hour_precip", "six_hour_precip",
]
# Feature order of a wine record.
WINE_FEATURES = [
    "fixed_acidity", "volatile_acidity", "citric_acid", "residual_sugar", "chlorides",
    "free_sulfur_dioxide", "total_sulfur_dioxide", "density", "ph", "sulphates", "alcohol",
]
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"


def _all_present(columns: list[str]) -> Column:
    valid = F.lit(True)
    for name in columns:
        valid = valid & F.col(name).isNotNull()
    return valid


def _evaluated_once(df: DataFrame, columns: list[Column]) -> DataFrame:
    """Add columns that are computed once per row. A filter on an ordinary projection
    is pushed below it and computes the filtered columns a second time; a generator
    of one row stops that."""
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def parse_weather(lines: DataFrame, column: str = "value") -> DataFrame:
    """14 typed columns from 13 comma-separated fields; the sky text is empty.
    Other columns of `lines` are kept."""
    fields = F.col("_f")
    typed = [F.trim(F.get(fields, F.lit(i))).try_cast(kind).alias(name)
             for i, (name, kind) in enumerate(WEATHER_CSV)]
    out = _evaluated_once(lines.withColumn("_f", F.split(F.col(column), ",")),
                          [*typed, (F.size(fields) >= len(WEATHER_CSV)).alias("_arity")])
    out = out.withColumn("sky_condition_text", F.lit(""))
    valid = F.col("_arity") & _all_present([n for n, _ in WEATHER_CSV])
    keep = [c for c in lines.columns if c not in WEATHER_COLUMNS]
    return out.select(*keep, *WEATHER_COLUMNS, valid.alias("is_valid"))


def parse_taxi(lines: DataFrame, column: str = "value") -> DataFrame:
    """Taxi events from nine comma-separated fields. END records carry their two
    times in reverse order; empty coordinates become 0."""
    f = F.col("_f")

    def field(i: int) -> Column:
        return F.get(f, F.lit(i))

    def time(i: int) -> Column:
        return F.try_to_timestamp(field(i), F.lit(TIME_PATTERN)).cast("timestamp_ntz")

    def coord(i: int) -> Column:
        return F.when(field(i) == "", F.lit(0.0).cast("float")).otherwise(field(i).try_cast("float"))

    out = _evaluated_once(lines.withColumn("_f", F.split(F.col(column), ",")), [
        field(0).try_cast("bigint").alias("ride_id"),
        F.when(field(1) == "START", F.lit(True)).when(field(1) == "END", F.lit(False)).alias("is_start"),
        time(2).alias("_own"), time(3).alias("_other"),
        coord(4).alias("start_lon"), coord(5).alias("start_lat"),
        coord(6).alias("end_lon"), coord(7).alias("end_lat"),
        field(8).try_cast("smallint").alias("passenger_cnt"),
        (F.size(f) == 9).alias("_arity")])
    start = F.col("is_start")
    own, other = F.col("_own"), F.col("_other")
    valid = F.col("_arity") & _all_present([
        "ride_id", "is_start", "_own", "_other", "start_lon", "start_lat", "end_lon", "end_lat", "passenger_cnt"])
    # The own time of an event is the first of the two; it is the event time.
    return out.select(*lines.columns, "ride_id", "is_start",
                      F.when(start, own).otherwise(other).alias("start_t"),
                      F.when(start, other).otherwise(own).alias("end_t"),
                      "start_lon", "start_lat", "end_lon", "end_lat", "passenger_cnt",
                      own.alias("event_time"), valid.alias("is_valid"))


def format_taxi(rides: DataFrame) -> DataFrame:
    """The inverse of `parse_taxi`: one `value` line per event."""
    def text(t: str) -> Column:
        return F.date_format(F.col(t), TIME_PATTERN)

    start = F.col("is_start")
    return rides.select(F.concat_ws(
        ",", F.col("ride_id").cast("string"),
        F.when(start, "START").otherwise("END"),
        F.when(start, text("start_t")).otherwise(text("end_t")),
        F.when(start, text("end_t")).otherwise(text("start_t")),
        *[F.col(c).cast("string") for c in
          ("start_lon", "start_lat", "end_lon", "end_lat", "passenger_cnt")],
    ).alias("value"))


def parse_prediction(lines: DataFrame, column: str = "value") -> DataFrame:
    """`ride id, minutes`; extra fields are ignored."""
    f = F.col("_f")
    out = _evaluated_once(lines.withColumn("_f", F.split(F.col(column), ",")), [
        F.trim(F.get(f, F.lit(0))).try_cast("bigint").alias("ride_id"),
        F.trim(F.get(f, F.lit(1))).try_cast("int").alias("minutes")]).drop("_f")
    return out.withColumn("is_valid", _all_present(["ride_id", "minutes"]))


def parse_wine(lines: DataFrame, column: str = "value") -> DataFrame:
    """Eleven features from a `;`-separated line; the quality label is dropped."""
    f = F.col("_f")
    typed = [F.trim(F.get(f, F.lit(i))).try_cast("double").alias(n)
             for i, n in enumerate(WINE_FEATURES)]
    out = _evaluated_once(lines.withColumn("_f", F.split(F.col(column), ";")), typed).drop("_f")
    out = out.withColumn("data_type", F.lit("wine"))
    return out.withColumn("is_valid", _all_present(WINE_FEATURES))


def parse_json(lines: DataFrame, schema: str, required: list[str], column: str = "value") -> DataFrame:
    """JSON records by a declared schema; `required` fields must be present."""
    m = F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"})
    out = _evaluated_once(lines, [m.alias("_m")]).select(*lines.columns, "_m.*")
    return out.withColumn("is_valid", _all_present(required))


def to_json_lines(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def keep_valid(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("is_valid")).drop("is_valid")


def split_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows). Both read the same source; write them from one
    persisted micro-batch when the source is expensive."""
    return keep_valid(parsed), parsed.where(~F.coalesce(F.col("is_valid"), F.lit(False))).drop("is_valid")


def parse_properties(lines: DataFrame, run: str = "run", column: str = "value") -> DataFrame:
    """Key=value lines of many run files to one row per run: a map, and a suffix
    made of the values in key order. Comments and lines without `=` are skipped.
    A run file is a handful of hyperparameters, so a run's map is small."""
    text = F.trim(F.col(column))
    kv = F.split(text, "=", 2)
    pairs = (lines.where(~text.startswith("#") & text.contains("="))
             .select(run, F.trim(kv[0]).alias("k"), F.trim(kv[1]).alias("v"))
             .groupBy(run, "k").agg(F.max("v").alias("v")))
    entries = F.array_sort(F.collect_list(F.struct("k", "v")))
    out = pairs.groupBy(run).agg(entries.alias("e"))
    return out.select(run, F.map_from_entries("e").alias("props"),
                      F.concat_ws("", F.transform("e", lambda x: x["v"])).alias("suffix"))
