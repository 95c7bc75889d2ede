"""Taxi rides: parsing, geography, regression and prediction."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.fixtures import duck, view
from tidegauge.functions import geo, parse, sql
from tidegauge.operators import ordered, taxi
from tidegauge.plans.common import r, rounded

QUERIES = {}
SQL = {}


def _rides(s, d):
    return view(s, d, "taxi_rides")


# Parsing ------------------------------------------------------------------------

def _taxi_parse(s, d):
    p = parse.keep_valid(parse.parse_taxi(view(s, d, "taxi_lines")))
    text = {c: F.date_format(c, parse.TIME_PATTERN) for c in ("start_t", "end_t", "event_time")}
    return rounded(p.withColumns(text).withColumn("passenger_cnt", F.col("passenger_cnt").cast("int"))
                   .drop("value"))


_TIME = "try_strptime(f[{i}], '%Y-%m-%d %H:%M:%S')"
_COORD = "case when f[{i}] = '' then cast(0 as float) else try_cast(f[{i}] as float) end"
_TAXI = f"""
f as (select line_id, string_split(value, ',') as f from taxi_lines),
p as (select line_id, len(f) as n, try_cast(f[1] as bigint) as ride_id,
  case f[2] when 'START' then true when 'END' then false end as is_start,
  case when f[2] = 'START' then {_TIME.format(i=3)} else {_TIME.format(i=4)} end as start_t,
  case when f[2] = 'START' then {_TIME.format(i=4)} else {_TIME.format(i=3)} end as end_t,
  {_COORD.format(i=5)} as start_lon, {_COORD.format(i=6)} as start_lat,
  {_COORD.format(i=7)} as end_lon, {_COORD.format(i=8)} as end_lat, try_cast(f[9] as smallint) as passenger_cnt from f)"""
_OUT = ", ".join(f"strftime({e}, '%Y-%m-%d %H:%M:%S') as {n}" for e, n in (
    ("start_t", "start_t"), ("end_t", "end_t"), ("case when is_start then start_t else end_t end", "event_time")))
QUERIES["taxi_parse"] = _taxi_parse
SQL["taxi_parse"] = duck(
    f"with {_TAXI} select line_id, ride_id, is_start, {_OUT}, "
    + ", ".join(r(c, c) for c in ("start_lon", "start_lat", "end_lon", "end_lat"))
    + ", cast(passenger_cnt as int) as passenger_cnt from p where n = 9 and ride_id is not null and is_start is not null "
    "and start_t is not null and end_t is not null and start_lon is not null and start_lat is not null "
    "and end_lon is not null and end_lat is not null and passenger_cnt is not null", "taxi_lines")


def _round_trip(s, d):
    back = parse.keep_valid(parse.parse_taxi(parse.format_taxi(_rides(s, d))))
    return rounded(back.select("ride_id", "is_start", "start_lon", "start_lat", "end_lon", "end_lat",
                               F.date_format("event_time", parse.TIME_PATTERN).alias("event_time")))


QUERIES["taxi_format"] = _round_trip
SQL["taxi_format"] = duck(
    "select ride_id, is_start, strftime(event_time, '%Y-%m-%d %H:%M:%S') as event_time, "
    + ", ".join(r(c, c) for c in ("start_lon", "start_lat", "end_lon", "end_lat")) + " from taxi_rides", "taxi_rides")

QUERIES["pred_parse"] = lambda s, d: parse.keep_valid(parse.parse_prediction(view(s, d, "pred_lines"))).drop("value")
SQL["pred_parse"] = duck(
    "with f as (select line_id, string_split(value, ',') as f from pred_lines), p as (select line_id, "
    "try_cast(trim(f[1]) as bigint) as ride_id, try_cast(trim(f[2]) as int) as minutes from f) "
    "select * from p where ride_id is not null and minutes is not null", "pred_lines")

# Geography ----------------------------------------------------------------------

_LON_OK = "(cast({0}_lon as double) between -74.05::double and -73.7::double)"
_LAT_OK = "(cast({0}_lat as double) between 40.5::double and 41.0::double)"


def _inside(strict):
    op = "and" if strict else "or"
    return " and ".join(f"({_LON_OK.format(p)} {op} {_LAT_OK.format(p)})" for p in ("start", "end"))


for _name, _strict in (("nyc_filter", False), ("nyc_filter_strict", True)):
    QUERIES[_name] = lambda s, d, strict=_strict: view(s, d, "rides_wide").where(
        geo.in_city("start_lon", "start_lat", strict) & geo.in_city("end_lon", "end_lat", strict)).select("ride_id")
    SQL[_name] = duck(f"select ride_id from rides_wide where {_inside(_strict)}", "rides_wide")

_X = "cast(floor((74.05::double - abs(cast({0} as double))) / 0.0014::double) as int)"
_Y = "cast(floor((41.0::double - cast({0} as double)) / 0.00125::double) as int)"


def _cell(lon, lat):
    return f"({_X.format(lon)} + {_Y.format(lat)} * 250)"


QUERIES["grid_cell"] = lambda s, d: view(s, d, "rides_wide").select(
    "ride_id", geo.grid_cell("start_lon", "start_lat").alias("start_cell"), geo.grid_cell("end_lon", "end_lat").alias("end_cell"))
SQL["grid_cell"] = duck(
    f"select ride_id, {_cell('start_lon', 'start_lat')} as start_cell, {_cell('end_lon', 'end_lat')} as end_cell from rides_wide",
    "rides_wide")


def _centers(s, d):
    c = view(s, d, "rides_wide").select(geo.grid_cell("start_lon", "start_lat").alias("cell")).distinct()
    return rounded(c.select("cell", geo.cell_center_lon("cell").alias("lon"), geo.cell_center_lat("cell").alias("lat")))


QUERIES["cell_center"] = _centers
SQL["cell_center"] = duck(
    f"with c as (select distinct {_cell('start_lon', 'start_lat')} as cell from rides_wide), x as (select cell, cell % 250 as x from c) "
    "select cell, " + r("-cast(74.05::double - x * 0.0014::double - 0.0007::double as float)", "lon") + ", "
    + r("cast(41.0::double - ((cell - x) // 250) * 0.00125::double - 0.000625::double as float)", "lat") + " from x", "rides_wide")

_DLAT = "(start_lat - end_lat)"
_DIST = (f"(110.25::double * sqrt(cast({_DLAT} * {_DLAT} as double) + pow(cast(start_lon - end_lon as double) "
         "* cos(cast(end_lat as double)), 2)))")
_ANGLE = (f"(cast(trunc(degrees(atan2(cast({_DLAT} as double), cast(start_lon - end_lon as double) "
          "* cos(cast(end_lat as double))))) as int) + 179)")
_BUCKET = f"cast(trunc({_ANGLE} / 45.0::double) as int)"

QUERIES["geo_distance"] = lambda s, d: rounded(view(s, d, "rides_base").select(
    "ride_id", geo.distance_km("start_lon", "start_lat", "end_lon", "end_lat").alias("dist")))
SQL["geo_distance"] = duck(f"select ride_id, {r(_DIST, 'dist')} from rides_base", "rides_base")


def _angles(s, d):
    angle = geo.direction_angle("end_lon", "end_lat", "start_lon", "start_lat")
    return view(s, d, "rides_base").select("ride_id", angle.alias("angle"), geo.direction_bucket(angle).alias("bucket"))


QUERIES["geo_angle"] = _angles
SQL["geo_angle"] = duck(f"select ride_id, {_ANGLE} as angle, {_BUCKET} as bucket from rides_base", "rides_base")

QUERIES["path_cells"] = lambda s, d: taxi.path_traffic(view(s, d, "rides_base"))
SQL["path_cells"] = duck(f"""
with p as (select {_X.format('start_lon')} as x1, {_Y.format('start_lat')} as y1, {_X.format('end_lon')} as x2,
  {_Y.format('end_lat')} as y2 from rides_base),
q as (select x1, y1, x2 - x1 as dx, y2 - y1 as dy, greatest(abs(x2 - x1), abs(y2 - y1)) as n from p),
s as (select *, unnest(range(0, n + 1)) as i from q)
select cast(x1 + floor(dx * i / greatest(n, 1)::double + 0.5) + (y1 + floor(dy * i / greatest(n, 1)::double + 0.5)) * 250 as int) as cell,
  cast(count(*) as bigint) as rides from s group by cell""", "rides_base")

# Regression and prediction ------------------------------------------------------

_FEATURES = f"""
ft as (select ride_id, is_start, event_time, {_cell('end_lon', 'end_lat')} as cell, {_BUCKET} as bucket, {_DIST} as dist,
  case when not is_start then (epoch_ms(end_t) - epoch_ms(start_t)) / 60000.0::double end as minutes
  from taxi_rides where {_inside(False)})"""

QUERIES["regression_fit"] = lambda s, d: rounded(taxi.regression_fit(taxi.ride_features(_rides(s, d))))
SQL["regression_fit"] = duck(
    f"with {_FEATURES} select cell, bucket, cast(count(*) as bigint) as n, "
    + r("case when count(*) >= 2 and sum(dist * dist) > 0 then sum(dist * minutes) / sum(dist * dist) end", "slope")
    + " from ft where not is_start group by cell, bucket", "taxi_rides")

QUERIES["taxi_predict"] = lambda s, d: taxi.predict(taxi.ride_features(_rides(s, d)))
SQL["taxi_predict"] = duck(f"""
with {_FEATURES}, w as (select *, count(minutes) over o as n, sum(dist * minutes) over o as sxy,
  sum(case when not is_start then dist * dist end) over o as sxx from ft
  window o as (partition by cell, bucket order by event_time, is_start desc, ride_id rows between unbounded preceding and 1 preceding)),
p as (select ride_id, cast(trunc(sxy / sxx * dist) as int) as minutes from w where is_start and n >= 2 and sxx > 0)
select * from p where minutes >= 0""", "taxi_rides")


def _ride_order(s, d):
    rides = _rides(s, d).select("ride_id", "is_start", "event_time")
    return ordered.ordered_index(rides, ordered.ride_order(), "event_time", "rn").drop("event_time")


QUERIES["ride_order"] = _ride_order
SQL["ride_order"] = duck(
    "select ride_id, is_start, cast(row_number() over (order by event_time, is_start desc, ride_id) as bigint) as rn from taxi_rides",
    "taxi_rides")

# Events without a time are numbered first.
_NO_TIME = "case when ride_id % 53 <> 0 then event_time end"


def _ride_order_nulls(s, d):
    rides = _rides(s, d).withColumn("event_time", F.expr(_NO_TIME)).select("ride_id", "is_start", "event_time")
    return ordered.ordered_index(rides, ordered.ride_order(), "event_time", "rn").drop("event_time")


QUERIES["ride_order_nulls"] = _ride_order_nulls
SQL["ride_order_nulls"] = duck(
    f"select ride_id, is_start, cast(row_number() over (order by {_NO_TIME} nulls first, is_start desc, ride_id) as bigint) as rn "
    "from taxi_rides", "taxi_rides")


def _by_name(s, d):
    sql.register(s)
    return rounded(s.sql(
        "select ride_id, grid_cell(start_lon, start_lat) as cell, in_city(start_lon, start_lat) as inside, "
        "distance_km(start_lon, start_lat, end_lon, end_lat) as dist from {rides}", rides=view(s, d, "rides_wide")))


# The functions called by name in SQL text.
QUERIES["sql_functions"] = _by_name
SQL["sql_functions"] = duck(
    f"select ride_id, {_cell('start_lon', 'start_lat')} as cell, ({_LON_OK.format('start')} or {_LAT_OK.format('start')}) as inside, "
    f"{r(_DIST, 'dist')} from rides_wide", "rides_wide")
