"""Typed views over the test tables, shared by queries, tests and benchmarks.

Every view is one SQL text read by Spark and by DuckDB. `{name}` stands for another
view or a table. The few spellings that differ are given per engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

_RIDE_COLUMNS = "start_lon, start_lat, end_lon, end_lat, passenger_cnt"
_RIDE_TIMES = {
    "spark": "timestampadd(SECOND, start_s, start_date) as start_t, timestampadd(SECOND, start_s + dur_s, start_date) as end_t",
    "duckdb": "start_date + to_seconds(start_s) as start_t, start_date + to_seconds(start_s + dur_s) as end_t",
}
_TIME_TEXT = {"spark": "date_format({t}, 'yyyy-MM-dd HH:mm:ss')", "duckdb": "strftime({t}, '%Y-%m-%d %H:%M:%S')"}
_MILLIS = {"spark": "unix_millis(cast(ts as timestamp))", "duckdb": "epoch_us(ts) // 1000"}

VIEWS: dict[str, str] = {
    "weather_raw": """
with b as (select *, date '2008-01-01' + cast((day(ts) - 1) * 24 + hour(ts) as int) as dt from {events})
select event_id as seq, concat('S', cast(user_id % 4 as varchar(10))) as wsid,
  cast(year(dt) as int) as year, cast(month(dt) as int) as month, cast(day(dt) as int) as day,
  cast(floor(minute(ts) * cast(0.4 as double)) as int) as hour,
  value as temperature, value - cast(5 as double) as dewpoint,
  case when event_id % 37 = 0 then cast(0 as double)
       else cast(980 as double) + cast((event_id * 7919) % 600 as double) / cast(10 as double) end as pressure,
  cast((event_id * 53) % 360 as int) as wind_direction,
  cast((event_id * 31) % 200 as double) / cast(10 as double) as wind_speed,
  cast(event_id % 20 as int) as sky_condition, '' as sky_condition_text,
  case when event_id % 5 = 0 then cast(event_id % 13 as double) / cast(10 as double) else cast(0 as double) end as one_hour_precip,
  cast(0 as double) as six_hour_precip
from b""",
    # Text records; some have a missing field or a word where a number belongs.
    "weather_lines": """
select seq, case when seq % 97 = 0 then 'not,a,record'
  when seq % 89 = 0 then concat_ws(',', wsid, 'x', '1', '1', '0', '1', '1', '1', '1', '1', '1', '1', '1')
  else concat_ws(',', wsid, cast(year as varchar(10)), cast(month as varchar(10)), cast(day as varchar(10)),
    cast(hour as varchar(10)), cast(temperature as varchar(30)), cast(dewpoint as varchar(30)),
    cast(pressure as varchar(30)), cast(wind_direction as varchar(10)), cast(wind_speed as varchar(30)),
    cast(sky_condition as varchar(10)), cast(one_hour_precip as varchar(30)), cast(six_hour_precip as varchar(30))) end as value
from {weather_raw}""",
    "rides_base": """
select o_orderkey as ride_id, o_orderkey % 3 <> 0 as has_end, o_orderdate as start_date,
  cast((o_orderkey * 7919) % 86400 as int) as start_s, cast(300 + (o_orderkey * 131) % 3600 as int) as dur_s,
  cast(cast(-74.04 as double) + cast((o_orderkey * 37) % 330 as double) / cast(1000 as double) as float) as start_lon,
  cast(cast(40.51 as double) + cast((o_orderkey * 101) % 480 as double) / cast(1000 as double) as float) as start_lat,
  cast(cast(-73.9793 as double) + cast(0.0014 as double) * cast(o_custkey % 5 as double) as float) as end_lon,
  cast(cast(40.750625 as double) + cast(0.00125 as double) * cast(o_custkey % 4 as double) as float) as end_lat,
  cast(1 + o_orderkey % 6 as smallint) as passenger_cnt
from {orders}""",
    "rides_timed": "select *, {@times} from {rides_base}",
    "taxi_rides": f"""
select ride_id, true as is_start, start_t as event_time, start_t, end_t, {_RIDE_COLUMNS} from {{rides_timed}}
union all
select ride_id, false as is_start, end_t as event_time, start_t, end_t, {_RIDE_COLUMNS} from {{rides_timed}} where has_end""",
    # Rides that partly leave the city box in one or both coordinates.
    "rides_wide": """
select ride_id,
  cast(cast(start_lon as double) - cast(ride_id % 7 as double) / cast(10 as double) as float) as start_lon,
  cast(cast(start_lat as double) + cast(ride_id % 5 as double) / cast(4 as double) as float) as start_lat,
  end_lon, end_lat
from {rides_base}""",
    "taxi_lines": """
select ride_id as line_id, case when ride_id % 101 = 0 then concat('bad,', cast(ride_id as varchar(20)))
  else concat_ws(',', cast(ride_id as varchar(20)), case when is_start then 'START' else 'END' end,
    case when is_start then {@start_text} else {@end_text} end, case when is_start then {@end_text} else {@start_text} end,
    case when ride_id % 11 = 0 then '' else cast(start_lon as varchar(30)) end, cast(start_lat as varchar(30)),
    cast(end_lon as varchar(30)), cast(end_lat as varchar(30)), cast(passenger_cnt as varchar(10))) end as value
from {taxi_rides}""",
    "cpu": """
select event_id as seq, ts, value / cast(500 as double) as utilization,
  case when event_type = 'error' then 1 else 0 end as class,
  case when user_id % 10 = 0 then '' else concat('cpu', cast(user_id % 3 as varchar(5))) end as data_type
from {events}""",
    "models": """
select 'a' as model, 'cpu0' as data_type, cast(100 as bigint) as seq
union all select 'b', 'cpu0', cast(5000 as bigint)
union all select 'c', 'cpu1', cast(0 as bigint)""",
    # A version stream as long as the data: every signup publishes a version.
    "published": """
select concat('v', cast(event_id as varchar(20))) as model, concat('cpu', cast(user_id % 3 as varchar(5))) as data_type,
  event_id as seq from {events} where event_type = 'signup'""",
    # Timeouts set by signups; some are not positive and mean the default.
    "controls": """
select event_id as seq, concat('cpu', cast(user_id % 3 as varchar(5))) as data_type,
  cast(case when event_id % 4 = 0 then -1 else 50 + event_id % 100 end as bigint) as tmout
from {events} where event_type = 'signup'""",
    "requests": """
select event_id as request_id, concat('cpu', cast(user_id % 3 as varchar(5))) as data_type,
  case when event_type = 'error' then 1 else 0 end as class, {@millis} as req_ts
from {events}""",
    "responses": "\nunion all\n".join(f"""
select request_id, 'm{m}' as model, (request_id + {m}) % 5 <> 0 as processed,
  case when (request_id + {m}) % 7 = 0 then cast(null as int) else cast((request_id * {m + 1}) % 3 % 2 as int) end as result,
  class as source, (request_id * {31 * m}) % 200 as latency, req_ts + (request_id * {31 * m}) % 200 as resp_ts
from {{requests}}""".strip() for m in (1, 2, 3)),
    "wine": """
select l_orderkey * 10 + l_linenumber as seq,
  cast(4 as double) + l_quantity / cast(5 as double) as fixed_acidity, l_discount * cast(10 as double) as volatile_acidity,
  l_tax * cast(8 as double) as citric_acid, cast(l_partkey % 90 as double) / cast(10 as double) as residual_sugar,
  cast(10 + l_suppkey % 60 as double) / cast(1000 as double) as chlorides, cast(l_partkey % 60 as double) as free_sulfur_dioxide,
  cast(20 + l_orderkey % 140 as double) as total_sulfur_dioxide,
  cast(0.99 as double) + cast(l_suppkey % 14 as double) / cast(1000 as double) as density,
  cast(3 as double) + cast(l_linenumber as double) / cast(10 as double) as ph,
  cast(0.4 as double) + cast(l_partkey % 9 as double) / cast(10 as double) as sulphates,
  cast(8.5 as double) + cast(l_orderkey % 60 as double) / cast(10 as double) as alcohol, 'wine' as data_type, l_linenumber as line, l_shipdate as ts
from {lineitem}""",
    "wine_lines": """
select seq, case when seq % 83 = 0 then '7.4;0.7' else concat_ws(';', cast(fixed_acidity as varchar(30)),
  cast(volatile_acidity as varchar(30)), cast(citric_acid as varchar(30)), cast(residual_sugar as varchar(30)),
  cast(chlorides as varchar(30)), cast(free_sulfur_dioxide as varchar(30)), cast(total_sulfur_dioxide as varchar(30)),
  cast(density as varchar(30)), cast(ph as varchar(30)), cast(sulphates as varchar(30)), cast(alcohol as varchar(30)), '5') end as value
from {wine}""",
    # Properties of many training runs, one line each, with comments between them.
    "run_lines": """
select concat('run', cast(user_id as varchar(20))) as run,
  case when event_id % 5 = 0 then '# note = 1' when event_id % 7 = 0 then 'no assignment'
  else concat('  ', event_type, ' = ', cast(event_id % 100 as varchar(10)), '=x ') end as value
from {events}""",
    "pred_lines": """
select o_orderkey as line_id, case when o_orderkey % 13 = 0 then 'oops' when o_orderkey % 17 = 0 then 'x,12'
  else concat(cast(o_orderkey as varchar(20)), ',', cast(o_custkey % 60 as varchar(10)), ',extra') end as value
from {orders}""",
}


def _text(name: str, engine: str) -> str:
    t = _TIME_TEXT[engine]
    parts = {"times": _RIDE_TIMES[engine], "millis": _MILLIS[engine],
             "start_text": t.format(t="start_t"), "end_text": t.format(t="end_t")}
    sql = VIEWS[name]
    for key, value in parts.items():
        sql = sql.replace("{@" + key + "}", value)
    return sql


def _needs(name: str) -> list[str]:
    return [n for n in [*VIEWS, *TABLES] if "{" + n + "}" in VIEWS.get(name, "")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in TABLES:
        return table(spark, sf_dir, name)
    inputs = {n: view(spark, sf_dir, n) for n in _needs(name)}
    return spark.sql(_text(name, "spark"), **inputs)


def duck(body: str, *names: str) -> str:
    """`body` with the named views before it as common table expressions."""
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in VIEWS and n not in seen:
            for d in _needs(n):
                visit(d)
            seen.append(n)

    for n in names:
        visit(n)
    ctes = []
    for n in seen:
        sql = _text(n, "duckdb")
        for d in _needs(n):
            sql = sql.replace("{" + d + "}", d)
        ctes.append(f"{n} as ({sql})")
    body = body.strip()
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return "with " + ",\n".join(ctes) + "\n" + body
