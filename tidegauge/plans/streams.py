"""The streaming forms, replayed over the test tables and checked with the SQL of
their batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.fixtures import TABLES, VIEWS, _needs, _text, duck
from tidegauge.functions import scalar
from tidegauge.operators import rollup
from tidegauge.plans import model_specs as specs
from tidegauge.plans import serving, taxi, weather
from tidegauge.plans.common import r, rounded
from tidegauge.session import shared_dir
from tidegauge.sinks import files
from tidegauge.sinks.tables import BatchFolder, UpsertTable
from tidegauge.sources import streams
from tidegauge.streaming import (change_rollup, incremental, model_join, model_stream, online, reorder, runner, travel_time,
                                 voting)

QUERIES = {}
SQL = {}


def stream_view(spark, sf_dir, name):
    """A fixture view over the tables read as streams."""
    if name in TABLES:
        schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
        return streams.files(spark, sf_dir, schema, pathGlobFilter=f"{name}.parquet")
    return spark.sql(_text(name, "spark"), **{n: stream_view(spark, sf_dir, n) for n in _needs(name)})


QUERIES["stream_daily_change"] = lambda s, d: rounded(runner.replay(
    change_rollup.daily_change_stream(stream_view(s, d, "weather_raw")), "daily_change"))
SQL["stream_daily_change"] = weather.SQL["daily_change"]

# Two chained stateful operators.
QUERIES["stream_monthly_change"] = lambda s, d: rounded(runner.replay(change_rollup.monthly_change_stream(
    change_rollup.daily_change_stream(stream_view(s, d, "weather_raw"))), "monthly_change"))
SQL["stream_monthly_change"] = weather.SQL["monthly_change"]

QUERIES["stream_taxi_predict"] = lambda s, d: runner.replay(
    travel_time.predict_stream(stream_view(s, d, "taxi_rides")), "taxi_predict")
SQL["stream_taxi_predict"] = taxi.SQL["taxi_predict"]

QUERIES["stream_asof_keyed"] = lambda s, d: runner.replay(model_join.keyed_versions_stream(
    stream_view(s, d, "cpu").select("seq", "data_type"), stream_view(s, d, "published"), "data_type", "seq", "model"),
    "asof_keyed")
SQL["stream_asof_keyed"] = serving.SQL["asof_published"]

# A request is out when the watermark has passed its timeout (the early form: or when all its
# responses are there). The replayed streams end with a late row of their own, which moves the
# watermark past the last requests, and come in several micro-batches.
_LIMIT, _PARTS = 100, 2
# Rows of a micro-batch that wait in state for the watermark: a hot key has all of them in one task.
_WAITING = 250_000


def in_order(s, rows, position, name, bounds=None):
    """`rows` in `_PARTS` parts in the order of a column, rows without a position in the first one:
    (folder, files of a part). Every part has the same number of files, written one part after the other,
    so micro-batches of that many files hold one part each. `bounds` are the least and the
    largest position where several streams have to be cut alike."""
    low, high = bounds or rows.agg(F.min(position), F.max(position)).first()
    if low is None:
        low, high = 0, 0
    part = F.coalesce(F.floor((F.col(position) - low) * _PARTS / (high - low + 1)), F.lit(0)).alias("part")
    sizes = {r[0]: r[1] for r in rows.groupBy(part).count().collect()}  # one row per part
    return _append(s, name, [sizes.get(i, 0) for i in range(_PARTS)], lambda i: rows.where(part == i))


def in_even_parts(s, rows, position, name):
    """As `in_order`, with as many parts as it takes for each to have about `_WAITING` rows, however many
    rows there are and however their positions are spread; the first one has those without a position besides.
    The table is read once for all parts."""
    parts = -(-rows.count() // _WAITING)
    if parts <= _PARTS:
        return in_order(s, rows, position, name)
    whole = shared_dir(s, f"{name}-parts")
    rows.repartitionByRange(parts, position).withColumn("_part", F.spark_partition_id()).write.partitionBy("_part").parquet(whole)
    sizes = sorted(tuple(r) for r in s.read.parquet(whole).groupBy("_part").count().collect())  # one row per part
    found = _append(s, name, [n for _, n in sizes],
                    lambda i: s.read.schema(rows.schema).parquet(f"{whole}/_part={sizes[i][0]}"))
    files.delete(s, whole)
    return found


def _append(s, name, sizes, part):
    path = shared_dir(s, name)
    count = max(1, min([s.sparkContext.defaultParallelism, *sizes]))
    for i in range(len(sizes)):
        part(i).repartition(count).write.mode("append").parquet(path)
    return path, count


def closed_stream(s, rows, time, name):
    """`rows` as a stream in several micro-batches, then one row of request -1."""
    path, count = in_order(s, rows, time, name)
    high = rows.agg(F.max(time)).first()[0]
    blank = {"string": F.lit(""), "boolean": F.lit(False)}
    last = {time: F.lit(high + 10_000_000), "request_id": F.lit(-1)}
    s.range(1).select(*[last.get(c, blank.get(t, F.lit(0))).cast(t).alias(c) for c, t in rows.dtypes]).write.mode(
        "append").parquet(path)
    return streams.files(s, path, rows.schema, max_files=count)


def shuffled(s, rows, time, tie, name, delay_ms=reorder.DELAY_MS):
    """`rows` as a stream whose events come up to `delay_ms` late, in several micro-batches (of a bounded number of
    rows, since all of them may wait in the state of one key), and at the end
    an event of its own (all else null) that lets the watermark pass the others. `tie`: columns that
    the lateness of a row is drawn from."""
    arrival = F.unix_millis(F.col(time)) + F.pmod(F.xxhash64(*tie), F.lit(delay_ms + 1))
    path, count = in_even_parts(s, rows.withColumn("_arrival", arrival), "_arrival", name)
    close = F.timestamp_millis(F.lit(rows.agg(F.max(F.unix_millis(time))).first()[0] + 86_400_000))
    cells = {time: close, "_arrival": F.lit(0)}
    schema = s.read.parquet(path).schema
    s.range(1).select(*[cells.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]).write.mode(
        "append").parquet(path)
    return streams.files(s, path, schema, max_files=count).drop("_arrival")


# Events out of order: the same rows as from the batch forms.
def _daily_late(s, d):
    raw = serving.view(s, d, "weather_raw").withColumn("time", F.timestamp_seconds(F.col("seq") + 1_000_000))
    stream = shuffled(s, raw, "time", ["seq"], "late-weather")
    return rounded(runner.replay(change_rollup.daily_change_stream(stream, time="time"), "late_daily"))


def _predict_late(s, d):
    rides = serving.view(s, d, "taxi_rides").withColumn("event_time", F.col("event_time").cast("timestamp"))
    stream = shuffled(s, rides, "event_time", ["ride_id", "is_start"], "late-rides")
    # The closing event has no place, so it is none of the rides in the city.
    inside = stream.fillna({c: v for c, v in (("start_lon", -74.0), ("end_lon", -74.0), ("start_lat", 40.7), ("end_lat", 40.7))})
    return runner.replay(travel_time.predict_stream(inside, delay_ms=reorder.DELAY_MS), "late_predict")


def _slide_late(s, d):
    cpu = serving.view(s, d, "cpu").withColumn("time", F.col("ts").cast("timestamp"))
    z = cpu.select("seq", "data_type", "time", scalar.standardize("utilization", serving._MEAN, serving._STD).alias("z"))
    stream = shuffled(s, z, "time", ["seq"], "late-cpu")
    v = runner.replay(online.sliding_vector_stream(stream, "data_type", "seq", "z", serving._W, time="time"), "late_slide")
    return rounded(v.select("seq", "data_type", *[F.col("vec")[i].alias(f"z{i}") for i in range(serving._W)]))


QUERIES["stream_late_daily"] = _daily_late
SQL["stream_late_daily"] = weather.SQL["daily_change"]
QUERIES["stream_late_predict"] = _predict_late
SQL["stream_late_predict"] = taxi.SQL["taxi_predict"]
QUERIES["stream_late_slide"] = _slide_late
SQL["stream_late_slide"] = serving.SQL["slide_vec"]


def parts_of(s, rows, position, name, bounds=None):
    path, count = in_order(s, rows, position, name, bounds)
    return streams.files(s, path, rows.schema, max_files=count)


def _slide_stream(s, d):
    cpu = serving.view(s, d, "cpu")
    z = cpu.select("seq", "data_type", scalar.standardize("utilization", serving._MEAN, serving._STD).alias("z"))
    v = runner.replay(online.sliding_vector_stream(parts_of(s, z, "seq", "slide"), "data_type", "seq", "z", serving._W), "slide")
    return rounded(v.select("seq", "data_type", *[F.col("vec")[i].alias(f"z{i}") for i in range(serving._W)]))


QUERIES["stream_slide_vec"] = _slide_stream
SQL["stream_slide_vec"] = serving.SQL["slide_vec"]


# Samples and the models published among them, served by one operator.
def _published_models(s, d):
    rows = [(m, k, data) for m, k, data in serving._REGISTRY]
    registry = s.createDataFrame(rows, "model string, model_type string, data binary")
    return serving.view(s, d, "models").join(F.broadcast(registry), "model").select(
        "data_type", "seq", "model", "model_type", "data", F.lit(serving._W).alias("width"),
        F.lit(float(serving._MEAN)).alias("mean"), F.lit(float(serving._STD)).alias("std"))


def _served_online(s, d):
    cpu = serving.view(s, d, "cpu").withColumn("data_type", scalar.default_key("data_type"))
    bounds = cpu.agg(F.min("seq"), F.max("seq")).first()
    models = _published_models(s, d).where(F.col("seq") <= bounds[1])
    served = online.serve_stream(parts_of(s, cpu, "seq", "online-cpu", bounds), parts_of(s, models, "seq", "online-models", bounds),
                                 "seq", ["seq", "data_type"])
    return runner.replay(served, "online")


QUERIES["stream_serving_rows"] = lambda s, d: _served_online(s, d).drop("duration")
SQL["stream_serving_rows"] = serving.SQL["serving_rows"]


# Models published mid-stream: another family at each quarter of the positions, a broken one among them.
_PUBLISHED = (("linear", 0), ("tree", 4), ("broken", 6), ("gamma", 8))
_WINE_MODELS = ("(select model, cast(lo + floor((hi - lo) * cast(f as double) / cast(12 as double)) as bigint) as seq, 'wine' as data_type "
                "from (select min(seq) as lo, max(seq) as hi from wine) b, ("
                + " union all ".join(f"select '{m}' as model, {f} as f" for m, f in _PUBLISHED) + ") p)")


def _wine_models(s, d):
    bytes_of = {"linear": specs.linear_pmml(), "tree": specs.tree_pmml(serving._DEPTH, 1, "reg"), "broken": "<PMML",
                "gamma": specs.general_pmml(specs.GAMMA, "gamma")}
    registry = s.createDataFrame([(m, "PMML", t.encode()) for m, t in bytes_of.items()],
                                 "model string, model_type string, data binary")
    places = s.sql(f"select * from {_WINE_MODELS}".replace(" from wine)", " from {wine})"), wine=serving.view(s, d, "wine"))
    return places.join(F.broadcast(registry), "model")


def _dispatch_stream(s, d):
    wine = serving.view(s, d, "wine").drop("ts")
    bounds = wine.agg(F.min("seq"), F.max("seq")).first()
    both = model_stream.with_models(parts_of(s, wine, "seq", "wine-records", bounds),
                                    parts_of(s, _wine_models(s, d), "seq", "wine-models", bounds), ["data_type"], "seq")
    store = model_stream.ModelStore(s, shared_dir(s, "wine-store"), ["data_type"], "seq")
    out = BatchFolder(s, shared_dir(s, "wine-scores"))
    runner.start(both, model_stream.dispatch_batches(store, wine.columns, out.write_batch), shared_dir(s, "wine-checkpoint"),
                 "wine_dispatch", available_now=True).awaitTermination()
    return rounded(out.read().select("seq", "line", "model", "score"))


QUERIES["stream_score_dispatch"] = _dispatch_stream
SQL["stream_score_dispatch"] = duck(
    f"with v as (select * from {_WINE_MODELS} q where model <> 'broken'), j as (select w.*, v.model from wine w asof left join v "
    "on w.data_type = v.data_type and w.seq >= v.seq) select seq, line, model, "
    + r(f"case model when 'linear' then {specs.linear_sql(specs.LINEAR)} when 'tree' then {specs.tree_score_sql(serving._DEPTH, 1, 'reg')} "
        f"when 'gamma' then {specs.linear_sql(specs.GAMMA)} end", "score") + " from j", "wine")


# Settings read as a stream: each request gets the one in force at its own time, then the votes are
# taken under it.
def _control_streams(s, d):
    requests, controls = serving.view(s, d, "requests"), serving.view(s, d, "controls")
    bounds = requests.agg(F.min("request_id"), F.max("request_id")).first()
    q = requests.withColumn("seq", F.col("request_id"))
    return model_join.control_stream(parts_of(s, q, "seq", "control-requests", bounds),
                                     parts_of(s, controls, "seq", "control-settings", bounds), "data_type", "seq", "tmout")


QUERIES["stream_control_asof"] = lambda s, d: runner.replay(_control_streams(s, d), "control").select(
    "request_id", "data_type", "tmout")
SQL["stream_control_asof"] = serving.SQL["control_asof"]


def _votes(form, name, own=None):
    def run(s, d):
        requests, responses = serving.view(s, d, "requests"), serving.view(s, d, "responses")
        more = {}
        if own:
            requests = runner.replay(_control_streams(s, d), f"{name}-limits").drop("seq").withColumnRenamed("tmout", "timeout")
            more = {"max_timeout_ms": own} if form is voting.vote_stream else {}
        out = runner.replay(form(closed_stream(s, requests, "req_ts", f"{name}-requests"),
                                 closed_stream(s, responses, "resp_ts", f"{name}-responses"), 3, _LIMIT, **more), name)
        return out.where("request_id >= 0")
    return run


_VOTES = "select dec.* exclude (data_type) from dec"
for _form, _name in ((voting.vote_stream, "vote_timeout"), (voting.vote_stream_early, "vote_early")):
    QUERIES[f"stream_{_name}"] = _votes(_form, _name)
    SQL[f"stream_{_name}"] = duck(f"with {serving.in_time_sql(str(_LIMIT), 'requests')} {_VOTES}", "requests", "responses")
QUERIES["stream_vote_control"] = _votes(voting.vote_stream, "vote_control", own=10_000)
SQL["stream_vote_control"] = duck(f"with {serving._TIMEOUTS}, {serving.in_time_sql('q.tmout', 'tm')} {_VOTES}",
                                  "requests", "responses", "controls")


def _stream_calendar(s, d):
    """Update mode: each micro-batch replaces the rows of the keys it touched."""
    table = UpsertTable(s, shared_dir(s, "daily-calendar"), ["wsid", "year", "month", "day"])
    q = runner.start(rollup.daily_calendar(stream_view(s, d, "weather_raw")), table.write_batch,
                     shared_dir(s, "daily-calendar-checkpoint"), "daily_calendar", "update", available_now=True)
    q.awaitTermination()
    return rounded(table.read())


QUERIES["stream_daily_calendar"] = _stream_calendar
SQL["stream_daily_calendar"] = weather.SQL["daily_calendar"]


# The per-batch forms, which divide hot keys of a micro-batch and keep no Python state.
def _daily_batches(s, d):
    table = UpsertTable(s, shared_dir(s, "daily-batches"), ["wsid", "last_order"])
    step = incremental.daily_change_batches(s, shared_dir(s, "daily-batches-state"), table.write_batch)
    runner.start(stream_view(s, d, "weather_raw"), step, shared_dir(s, "daily-batches-checkpoint"), "daily_batches",
                 available_now=True).awaitTermination()
    return rounded(table.read())


def _predict_batches(s, d):
    table = UpsertTable(s, shared_dir(s, "predict-batches"), ["ride_id"])
    step = incremental.predict_batches(s, shared_dir(s, "predict-batches-state"), table.write_batch)
    runner.start(stream_view(s, d, "taxi_rides"), step, shared_dir(s, "predict-batches-checkpoint"), "predict_batches",
                 available_now=True).awaitTermination()
    return table.read()


QUERIES["batches_daily_change"] = _daily_batches
SQL["batches_daily_change"] = weather.SQL["daily_change"]
QUERIES["batches_taxi_predict"] = _predict_batches
SQL["batches_taxi_predict"] = taxi.SQL["taxi_predict"]


# In several micro-batches: state carried from one to the next.
def _monthly_batches(s, d):
    table = UpsertTable(s, shared_dir(s, "monthly-batches"), ["wsid", "last_order"])
    root = shared_dir(s, "monthly-batches-state")
    months = incremental.monthly_change_batches(s, f"{root}/months", table.write_batch)
    days = incremental.daily_change_batches(s, f"{root}/days", months)
    raw = serving.view(s, d, "weather_raw")
    stream = parts_of(s, raw, "seq", "weather-files")
    runner.start(stream, days, shared_dir(s, "monthly-batches-checkpoint"), "monthly_batches",
                 available_now=True).awaitTermination()
    return rounded(table.read())


def _asof_batches(s, d):
    table = UpsertTable(s, shared_dir(s, "asof-batches"), ["seq"])
    step = model_join.per_batch_asof(lambda spark: serving.view(spark, d, "published"), "seq", "seq", ["model"],
                                     ["data_type"], table.write_batch)
    cpu = serving.view(s, d, "cpu").select("seq", "data_type")
    stream = parts_of(s, cpu, "seq", "cpu-files")
    runner.start(stream, step, shared_dir(s, "asof-batches-checkpoint"), "asof_batches",
                 available_now=True).awaitTermination()
    return table.read()


QUERIES["batches_monthly_change"] = _monthly_batches
SQL["batches_monthly_change"] = weather.SQL["monthly_change"]
QUERIES["batches_asof_keyed"] = _asof_batches
SQL["batches_asof_keyed"] = serving.SQL["asof_published"]
