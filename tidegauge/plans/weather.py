"""Weather: parsing, rollups, projections, lookups, stored tables and panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.fixtures import duck, view
from tidegauge.functions import parse
from tidegauge.operators import enrich, ordered, rollup, timeseries
from tidegauge.plans.common import five_sql, plain_five, r, rounded
from tidegauge.session import materialize
from tidegauge.sources import wire

QUERIES = {}
SQL = {}

_DAILY = ", ".join([five_sql("temperature", "temp", False), five_sql("wind_speed", "wind", False),
                    five_sql("pressure", "pressure", False), r("sum(one_hour_precip)", "precip")])
_MONTHLY = ", ".join([five_sql("temperature", "temp", False), five_sql("wind_speed", "wind", False),
                      five_sql("pressure", "pressure", False), five_sql("one_hour_precip", "precip", False)])


def _raw(spark, d):
    return view(spark, d, "weather_raw")


QUERIES["daily_calendar"] = lambda s, d: rounded(rollup.daily_calendar(_raw(s, d)))
SQL["daily_calendar"] = duck(f"select wsid, year, month, day, {_DAILY} from weather_raw group by all", "weather_raw")

QUERIES["monthly_calendar"] = lambda s, d: rounded(rollup.monthly_calendar(_raw(s, d)))
SQL["monthly_calendar"] = duck(f"select wsid, year, month, {_MONTHLY} from weather_raw group by all", "weather_raw")


def _daily_window(s, d):
    raw = _raw(s, d).withColumn("t", F.make_timestamp_ntz("year", "month", "day", "hour", F.lit(0), F.lit(0)))
    out = rollup.daily_window(raw, "t")
    day = F.date_format("window.start", "yyyy-MM-dd")
    return rounded(out.withColumn("day_start", day).drop("window"))


QUERIES["daily_window"] = _daily_window
SQL["daily_window"] = duck(
    f"select wsid, strftime(make_date(year, month, day), '%Y-%m-%d') as day_start, {_DAILY} "
    "from weather_raw group by wsid, day_start", "weather_raw")

# Change-triggered rollups -------------------------------------------------------

_RUNS = """
flagged as (select *, case when lag(day) over (partition by wsid order by seq) <> day then 1 else 0 end as chg from weather_raw),
numbered as (select *, sum(chg) over (partition by wsid order by seq) as run from flagged),
closed as (select * from numbered qualify run < max(run) over (partition by wsid))"""
_CHANGE = ", ".join([plain_five("temperature", "temp", True), plain_five("wind_speed", "wind", True),
                     plain_five("case when pressure > 1 then pressure end", "pressure", True),
                     "sum(one_hour_precip) as precip"])
_LABELS = "arg_max(year, seq) as year, arg_max(month, seq) as month, arg_max(day, seq) as day, max(seq) as last_order"
_CHANGE_NAMES = [f"{k}_{m}" for m in ("temp", "wind", "pressure") for k in ("high", "low", "mean", "variance", "stdev")]
_DAILY_RUNS = f"daily as (select wsid, run, {_LABELS}, {_CHANGE} from closed group by wsid, run)"

QUERIES["daily_change"] = lambda s, d: rounded(rollup.daily_change(_raw(s, d)))
SQL["daily_change"] = duck(
    f"with {_RUNS}, {_DAILY_RUNS} select wsid, year, month, day, last_order, "
    + ", ".join(r(c, c) for c in [*_CHANGE_NAMES, "precip"]) + " from daily", "weather_raw")

# The same with whole dates as the trigger.
QUERIES["daily_change_by_date"] = lambda s, d: rounded(
    rollup.daily_change(_raw(s, d), trigger=["year", "month", "day"]))
SQL["daily_change_by_date"] = SQL["daily_change"].replace(
    "lag(day) over (partition by wsid order by seq) <> day",
    "lag(make_date(year, month, day)) over (partition by wsid order by seq) <> make_date(year, month, day)")

# Missing stations and days are values: one station, and days that begin and end runs.
_GAPS = "nullif(wsid, case when seq % 13 = 0 then wsid end) as wsid, case when seq % 17 <> 0 then day end as day"
QUERIES["daily_change_nulls"] = lambda s, d: rounded(rollup.daily_change(
    s.sql(f"select * except (wsid, day), {_GAPS} from {{raw}}", raw=_raw(s, d))))
SQL["daily_change_nulls"] = SQL["daily_change"].replace(
    "case when lag(day) over (partition by wsid order by seq) <> day then 1 else 0 end as chg from weather_raw",
    "case when lag(day) over (partition by wsid order by seq) is distinct from day then 1 else 0 end as chg from "
    f"(select * exclude (wsid, day), {_GAPS} from weather_raw) g").replace("arg_max(day, seq) as day", "min(day) as day")

QUERIES["monthly_change"] = lambda s, d: rounded(rollup.monthly_change(
    materialize(rollup.daily_change(_raw(s, d)), "daily-change")))
SQL["monthly_change"] = duck(
    f"""with {_RUNS}, {_DAILY_RUNS},
mflag as (select *, case when lag(month) over (partition by wsid order by last_order) <> month then 1 else 0 end as mchg from daily),
mnum as (select *, sum(mchg) over (partition by wsid order by last_order) as mrun from mflag),
mclosed as (select * from mnum qualify mrun < max(mrun) over (partition by wsid))
select wsid, arg_max(year, last_order) as year, arg_max(month, last_order) as month, max(last_order) as last_order, """
    + ", ".join([five_sql("mean_temp", "temp", True), five_sql("mean_wind", "wind", True),
                 five_sql("mean_pressure", "pressure", True), five_sql("precip", "precip", True)])
    + " from mclosed group by wsid, mrun", "weather_raw")

QUERIES["stat_counter"] = lambda s, d: rounded(rollup.stat_counter(_raw(s, d), ["wsid"], "pressure"))
SQL["stat_counter"] = duck(
    "select wsid, cast(count(pressure) as bigint) as n, " + ", ".join([
        r("sum(pressure)", "total"), r("avg(pressure)", "mean"), r("max(pressure)", "high"),
        r("min(pressure)", "low"), r("var_pop(pressure)", "variance"), r("var_samp(pressure)", "sample_variance"),
        r("stddev_pop(pressure)", "stdev"), r("stddev_samp(pressure)", "sample_stdev")])
    + " from weather_raw group by wsid", "weather_raw")

# Projections --------------------------------------------------------------------

_SOURCE = {"temp": "temperature", "wind": "wind_speed", "pressure": "pressure", "precip": "one_hour_precip"}
for _m in ("temp", "wind", "pressure"):
    QUERIES[f"proj_daily_{_m}"] = lambda s, d, m=_m: rounded(
        rollup.project_daily(rollup.daily_calendar(_raw(s, d)), m))
    SQL[f"proj_daily_{_m}"] = duck(
        f"select wsid, year, month, day, {five_sql(_SOURCE[_m], '', False)} from weather_raw group by all", "weather_raw")
QUERIES["proj_daily_precip"] = lambda s, d: rounded(rollup.project_daily(rollup.daily_calendar(_raw(s, d)), "precip"))
SQL["proj_daily_precip"] = duck(
    f"select wsid, year, month, day, {r('sum(one_hour_precip)', 'precipitation')} from weather_raw group by all", "weather_raw")
for _m in ("temp", "wind", "pressure", "precip"):
    QUERIES[f"proj_monthly_{_m}"] = lambda s, d, m=_m: rounded(
        rollup.project_monthly(rollup.monthly_calendar(_raw(s, d)), m))
    SQL[f"proj_monthly_{_m}"] = duck(
        f"select wsid, year, month, {five_sql(_SOURCE[_m], '', False)} from weather_raw group by all", "weather_raw")


# Ad-hoc reads of the stored rollups ---------------------------------------------

def _daily_of_month(metric):
    def q(s, d):
        # The filter is on grouping columns, so it is applied before the aggregation.
        t = rollup.project_daily(rollup.daily_calendar(_raw(s, d)), metric)
        return rounded(t.where((F.col("year") == 2008) & (F.col("month") == 6))
                       .select("day", "wsid", "high", "low", "mean", "stdev", "variance"))
    return q


def _months_of_year(metric):
    def q(s, d):
        t = rollup.project_monthly(rollup.monthly_calendar(_raw(s, d)), metric)
        return rounded(t.where(F.col("year") == 2008)
                       .select("wsid", "month", "high", "low", "mean", "stdev", "variance"))
    return q


for _name, _m in (("temp", "temp"), ("pressure", "pressure")):
    QUERIES[f"q_daily_{_name}_month"] = _daily_of_month(_m)
    SQL[f"q_daily_{_name}_month"] = duck(
        f"select day, wsid, {five_sql(_SOURCE[_m], '', False)} from weather_raw "
        "where year = 2008 and month = 6 group by day, wsid", "weather_raw")
    QUERIES[f"q_monthly_{_name}_year"] = _months_of_year(_m)
    SQL[f"q_monthly_{_name}_year"] = duck(
        f"select wsid, month, {five_sql(_SOURCE[_m], '', False)} from weather_raw "
        "where year = 2008 group by wsid, month", "weather_raw")

# Parsing ------------------------------------------------------------------------

_COLS = ", ".join(parse.WEATHER_COLUMNS)
_RAW_OUT = ", ".join(r(c, c) if k == "double" else c for c, k in parse.WEATHER_CSV)
_FIELDS = ", ".join(f"try_cast(trim(f[{i + 1}]) as {'varchar' if k == 'string' else k}) as {c}"
                    for i, (c, k) in enumerate(parse.WEATHER_CSV))
_VALID = " and ".join(["n >= 13", *[f"{c} is not null" for c, _ in parse.WEATHER_CSV]])
_PARSED = (f"p as (select seq, len(f) as n, {_FIELDS} from "
           "(select seq, string_split(value, ',') as f from weather_lines) t)")

QUERIES["weather_parse"] = lambda s, d: rounded(
    parse.keep_valid(parse.parse_weather(view(s, d, "weather_lines"))).drop("value"))
SQL["weather_parse"] = duck(
    f"with {_PARSED} select seq, {_RAW_OUT}, '' as sky_condition_text from p where {_VALID}", "weather_lines")

QUERIES["drop_bad"] = lambda s, d: parse.split_bad(parse.parse_weather(view(s, d, "weather_lines")))[1].select("seq", "value")
SQL["drop_bad"] = duck(
    f"with {_PARSED} select seq, value from weather_lines where seq not in (select seq from p where {_VALID})", "weather_lines")

_JSON_SCHEMA = "wsid string, year int, month int, day int, hour int, temperature double, pressure double"
_JSON_COLS = ["wsid", "year", "month", "day", "hour", "temperature", "pressure"]


def _to_json(s, d):
    lines = parse.to_json_lines(_raw(s, d), ["seq", *_JSON_COLS])
    back = parse.parse_json(lines, "seq bigint, " + _JSON_SCHEMA, ["wsid", "seq"])
    return rounded(parse.keep_valid(back).drop("value"))


# Serialised and read back, so that the text form of numbers does not matter.
QUERIES["to_json"] = _to_json
SQL["to_json"] = duck(
    "select seq, wsid, year, month, day, hour, " + r("temperature", "temperature") + ", " + r("pressure", "pressure")
    + " from weather_raw", "weather_raw")

# Stored tables and lookups ------------------------------------------------------

_PK = ["wsid", "year", "month", "day", "hour"]
QUERIES["upsert_latest"] = lambda s, d: rounded(
    ordered.latest_per_key(_raw(s, d), _PK, [F.col("seq").desc()]).select("seq", *parse.WEATHER_COLUMNS))
_ALL = "seq, " + ", ".join(r(c, c) if c in ("temperature", "dewpoint", "pressure", "wind_speed", "one_hour_precip",
                                            "six_hour_precip") else c for c in parse.WEATHER_COLUMNS)
SQL["upsert_latest"] = duck(
    f"select {_ALL} from weather_raw qualify row_number() over (partition by {', '.join(_PK)} order by seq desc) = 1",
    "weather_raw")

QUERIES["latest_n_per_station"] = lambda s, d: rounded(
    ordered.latest_n(_raw(s, d), ["wsid"], [F.col(c).desc() for c in ("year", "month", "day", "hour", "seq")], 5)
    .select("wsid", "year", "month", "day", "hour", "seq", "temperature", "rn"))
SQL["latest_n_per_station"] = duck(
    "with t as (select *, cast(row_number() over (partition by wsid order by year desc, month desc, day desc, "
    "hour desc, seq desc) as int) as rn from weather_raw) select wsid, year, month, day, hour, seq, "
    + r("temperature", "temperature") + ", rn from t where rn <= 5", "weather_raw")

QUERIES["station_peek"] = lambda s, d: rounded(
    _raw(s, d).orderBy("wsid", F.desc("seq")).limit(5).select("wsid", "seq", "temperature"))
SQL["station_peek"] = duck(
    "select wsid, seq, " + r("temperature", "temperature") + " from weather_raw order by wsid, seq desc limit 5",
    "weather_raw")

_SKY = "sky as (select * from (values " + ", ".join(
    f"({code}, '{text}')" for code, text in enrich.SKY_CONDITIONS) + ") t(code, condition))"
QUERIES["sky_enrich"] = lambda s, d: enrich.sky_enrich(_raw(s, d)).select("seq", "wsid", "sky_condition", "condition")
SQL["sky_enrich"] = duck(
    f"with {_SKY} select seq, wsid, sky_condition, condition from weather_raw left join sky on sky_condition = code",
    "weather_raw")
# Stations from the nations; the records of one station have none.
_STATION_COLUMNS = ("concat('S', cast(n_nationkey as varchar(10))) as id, n_name as name, substr(n_name, 1, 2) as country_code, "
                   "cast(n_nationkey as double) * 1.5 as lat, cast(n_regionkey as double) - 3 as long, "
                   "cast(n_nationkey * 10 as double) as elevation")


def _station_enrich(s, d):
    stations = s.read.parquet(f"{d}/nation.parquet").where("n_nationkey <> 3").selectExpr(
        "concat('S', cast(n_nationkey as string)) as id", "n_name as name", "substr(n_name, 1, 2) as country_code",
        "cast(n_nationkey as double) * 1.5D as lat", "cast(n_regionkey as double) - 3 as long",
        "cast(n_nationkey * 10 as double) as elevation")
    return rounded(enrich.station_enrich(_raw(s, d).select("seq", "wsid"), stations))


QUERIES["station_enrich"] = _station_enrich
SQL["station_enrich"] = duck(
    f"select seq, wsid, name, country_code, {r('lat', 'lat')}, {r('long', 'long')}, {r('elevation', 'elevation')} "
    f"from weather_raw left join (select {_STATION_COLUMNS} from nation where n_nationkey <> 3) st on wsid = st.id",
    "weather_raw")
QUERIES["sky_unknown"] = lambda s, d: enrich.sky_unknown(_raw(s, d)).select("seq", "sky_condition")
SQL["sky_unknown"] = duck(
    f"with {_SKY} select seq, sky_condition from weather_raw where sky_condition not in (select code from sky)",
    "weather_raw")


def _sky_counts(s, d):
    known = enrich.lookup(_raw(s, d), enrich.sky_lookup(s), "sky_condition", "code", "inner")
    return known.groupBy("code", "condition").agg(F.count("*").alias("n"))


# The lookup table joined to its use in the data: rows per condition.
QUERIES["sky_lookup"] = _sky_counts
SQL["sky_lookup"] = duck(
    f"with {_SKY} select code, condition, cast(count(*) as bigint) as n from weather_raw join sky on sky_condition = code "
    "group by code, condition", "weather_raw")


def _src_union(s, d):
    parts = [_raw(s, d).where(F.col("sky_condition") < 10), _raw(s, d).where(F.col("sky_condition") >= 10)]
    return rounded(parts[0].unionByName(parts[1]).select("seq", "wsid", "temperature"))


QUERIES["src_union"] = _src_union
SQL["src_union"] = duck(
    "select seq, wsid, " + r("temperature", "temperature") + " from weather_raw", "weather_raw")


# Points and panels --------------------------------------------------------------

def _points(s, d):
    p = timeseries.raw_points(_raw(s, d), F.lit("2008-01-01 00:00:00").cast("timestamp_ntz"))
    f = {"temperature": "temperature", "pressure": "pressure", "windDirection": "wind_direction",
         "skyConditions": "sky_condition", "hour": "hour"}
    return rounded(p.select("measurement", F.col("tags")["station"].alias("station"),
                            *[F.col("fields")[k].alias(v) for k, v in f.items()]))


QUERIES["points"] = _points
SQL["points"] = duck(
    "select 'raw_weather' as measurement, wsid as station, "
    + ", ".join(r(c, c) for c in ("temperature", "pressure", "wind_direction", "sky_condition", "hour"))
    + " from weather_raw", "weather_raw")


def _timed(s, d):
    return _raw(s, d).withColumn("time", F.make_timestamp_ntz("year", "month", "day", "hour", F.lit(0), F.lit(0)))


_TIMED = "t as (select *, make_timestamp(year, month, day, hour, 0, 0) as time from weather_raw)"
_TIME_TEXT = "strftime(time, '%Y-%m-%d %H:%M:%S') as time"


def _text_time(df):
    return df.withColumn("time", F.date_format("time", parse.TIME_PATTERN))


QUERIES["panel_raw"] = lambda s, d: rounded(_text_time(timeseries.panel(
    _timed(s, d), "time", ["wsid"], ["temperature", "pressure", "dewpoint"])))
SQL["panel_raw"] = duck(
    f"with {_TIMED} select {_TIME_TEXT}, wsid, " + ", ".join(r(c, c) for c in ("temperature", "pressure", "dewpoint"))
    + " from t where time >= (select max(time) from t) - interval 1 hour", "weather_raw")


def _panel_rollup(grain):
    def q(s, d):
        roll = rollup.daily_calendar(_raw(s, d)) if grain == "daily" else rollup.monthly_calendar(_raw(s, d))
        day = F.col("day") if grain == "daily" else F.lit(1)
        t = roll.withColumn("time", F.make_timestamp_ntz("year", "month", day, F.lit(0), F.lit(0), F.lit(0)))
        window = "30 DAY" if grain == "daily" else "365 DAY"
        return rounded(_text_time(timeseries.panel(t, "time", ["wsid"], ["mean_temp", "low_temp", "high_temp"],
                                                   window=window)))
    return q


for _grain, _days in (("daily", 30), ("monthly", 365)):
    _key = "wsid, year, month, day" if _grain == "daily" else "wsid, year, month"
    _day = "day" if _grain == "daily" else "1"
    QUERIES[f"panel_{_grain}"] = _panel_rollup(_grain)
    SQL[f"panel_{_grain}"] = duck(
        f"with g as (select {_key}, avg(temperature) as mean_temp, min(temperature) as low_temp, max(temperature) as "
        f"high_temp from weather_raw group by all), t as (select *, make_timestamp(year, month, {_day}, 0, 0, 0) as time from g) "
        f"select {_TIME_TEXT}, wsid, " + ", ".join(r(c, c) for c in ("mean_temp", "low_temp", "high_temp"))
        + f" from t where time >= (select max(time) from t) - interval {_days} day", "weather_raw")

QUERIES["panel_pivot"] = lambda s, d: rounded(_text_time(timeseries.panel_by_tag(
    _timed(s, d), "time", "wsid", "temperature", ["S0", "S1", "S2", "S3"], window="1 DAY")))
SQL["panel_pivot"] = duck(
    f"with {_TIMED} select {_TIME_TEXT}, " + ", ".join(
        r(f"avg(temperature) filter (where wsid = 'S{i}')", f"S{i}") for i in range(4))
    + " from t where t.time >= (select max(time) from t) - interval 1 day group by t.time", "weather_raw")


# Records as protobuf bytes, some of them cut short, decoded again.
def _wire(s, d):
    raw = _raw(s, d)
    sent = raw.select("seq", wire.to_wire(raw, "WeatherRecord", wire.WEATHER_WIRE).alias("value"))
    broken = F.when(F.col("seq") % 41 == 0, F.lit(b"\x0a\xff")).otherwise(F.col("value"))
    return rounded(wire.decode_weather(sent.withColumn("value", broken)))


QUERIES["weather_wire"] = _wire
SQL["weather_wire"] = duck(f"select {_ALL} from weather_raw where seq % 41 <> 0", "weather_raw")
