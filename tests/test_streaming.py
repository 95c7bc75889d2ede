"""Streams fed file by file give the batch results, also after a restart."""

import os

import pytest
from pyspark.sql import functions as F

from tidegauge.fixtures import view
from tidegauge.operators import asof, rollup, taxi
from tidegauge.sinks import points, results
from tidegauge.sinks.tables import UpsertTable
from tidegauge.operators import timeseries
from tidegauge.sources import files, streams
from tidegauge.streaming import change_rollup, model_join, runner, travel_time, voting

SF_DIR = "/root/testdata/sf0.001"


def deliver(df, order, path, parts, first=0):
    """Write `df` as ordered files one after the other, with rising modification times."""
    os.makedirs(path, exist_ok=True)
    pdf = df.orderBy(order).toPandas()
    step = -(-len(pdf) // parts)
    for i in range(first, parts):
        name = f"{path}/{i:04d}.parquet"
        pdf.iloc[i * step:(i + 1) * step].to_parquet(name, coerce_timestamps="us")
        os.utime(name, (1_600_000_000 + i, 1_600_000_000 + i))


def bag(df, digits=6):
    rows = [tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()]
    return sorted(rows, key=lambda r: [(v is not None, v if v is not None else 0) for v in r])


def same(a, b):
    x, y = bag(a), bag(b)
    assert len(x) == len(y)
    for r, s in zip(x, y):
        assert all(v == pytest.approx(w, abs=1e-5) if isinstance(v, float) else v == w for v, w in zip(r, s))


def test_daily_change_over_batches_and_restart(spark, tmp_path):
    raw = view(spark, SF_DIR, "weather_raw")
    src, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = streams.files(spark, src, raw.schema, max_files=1)
        return runner.replay(change_rollup.daily_change_stream(stream), "daily", checkpoint=checkpoint, path=out)

    deliver(raw, "seq", src, 6)
    for i in range(3, 6):
        os.rename(f"{src}/{i:04d}.parquet", f"{tmp_path}/{i:04d}.parquet")
    run()
    for i in range(3, 6):
        os.rename(f"{tmp_path}/{i:04d}.parquet", f"{src}/{i:04d}.parquet")
    got = run()
    same(got, rollup.daily_change(raw))
    state = runner.read_state(spark, checkpoint, "open_run")
    assert state.count() == raw.select("wsid").distinct().count()


def test_predictions_over_batches(spark, tmp_path):
    rides = view(spark, SF_DIR, "taxi_rides").withColumn("event_time", F.col("event_time").cast("timestamp"))
    deliver(rides, "event_time", str(tmp_path / "in"), 4)
    stream = streams.files(spark, str(tmp_path / "in"), rides.schema, max_files=1)
    got = runner.replay(travel_time.predict_stream(stream), "predict")
    assert bag(got) == bag(taxi.predict(taxi.ride_features(rides)))


def test_versions_over_batches(spark, tmp_path):
    data = view(spark, SF_DIR, "cpu").select("seq", "data_type")
    versions = view(spark, SF_DIR, "published")
    deliver(data, "seq", str(tmp_path / "d"), 1)
    deliver(versions, "seq", str(tmp_path / "v"), 1)
    got = runner.replay(model_join.keyed_versions_stream(
        streams.files(spark, str(tmp_path / "d"), data.schema), streams.files(spark, str(tmp_path / "v"), versions.schema),
        "data_type", "seq", "model"), "versions")
    assert bag(got) == bag(asof.asof_join(data, versions, "seq", "seq", ["model"], ["data_type"]))


def test_version_table_per_batch(spark, tmp_path):
    data = view(spark, SF_DIR, "cpu").select("seq", "data_type")
    versions = view(spark, SF_DIR, "models")
    deliver(data, "seq", str(tmp_path / "d"), 3)
    table = UpsertTable(spark, str(tmp_path / "out"), ["seq"])
    run = model_join.per_batch_asof(lambda s: versions, "seq", "seq", ["model"], [], table.write_batch)
    q = runner.start(streams.files(spark, str(tmp_path / "d"), data.schema, max_files=1), run, str(tmp_path / "cp"), "asof",
                     available_now=True)
    q.awaitTermination()
    got, want = table.read(), asof.asof_join(data, versions, "seq", "seq", ["model"])
    assert sorted(map(str, got.select("seq", "model").collect())) == sorted(map(str, want.select("seq", "model").collect()))


def test_votes_early_and_by_watermark(spark, tmp_path):
    q = spark.createDataFrame([(1, 1000), (2, 1000), (3, 90_000)], "request_id bigint, req_ts bigint")
    r = spark.createDataFrame([(1, 1010, True, 1, 1), (1, 1020, True, 1, 1), (2, 1050, True, 0, 0), (2, 1500, True, 1, 0)],
                              "request_id bigint, resp_ts bigint, processed boolean, result int, source int")
    for name, form in (("q", voting.vote_stream), ("e", voting.vote_stream_early)):
        a, b = str(tmp_path / f"{name}-q"), str(tmp_path / f"{name}-r")
        deliver(q, "request_id", a, 1)
        deliver(r, "resp_ts", b, 1)
        got = {x.request_id: x for x in runner.replay(form(
            streams.files(spark, a, q.schema), streams.files(spark, b, r.schema), 2, 100), f"votes-{name}").collect()}
        if name == "e":
            assert set(got) == {1, 2}
            assert (got[1].votes, got[1].result, got[1].duration) == (2, 1, 20)
            assert (got[2].votes, got[2].result, got[2].duration) == (1, 0, 100)
        else:
            # The later stream decides how far the watermark gets.
            assert set(got) <= {1, 2}


def test_rollup_updates_replace_rows(spark, tmp_path):
    raw = view(spark, SF_DIR, "weather_raw")
    deliver(raw, "seq", str(tmp_path / "in"), 3)
    table = UpsertTable(spark, str(tmp_path / "out"), ["wsid", "year", "month"])
    q = runner.start(rollup.monthly_calendar(streams.files(spark, str(tmp_path / "in"), raw.schema, max_files=1)),
                     table.write_batch, str(tmp_path / "cp"), "monthly", "update", available_now=True)
    q.awaitTermination()
    same(table.read(), rollup.monthly_calendar(raw))


def test_windowed_rollup_with_watermark(spark, tmp_path):
    raw = view(spark, SF_DIR, "weather_raw").withColumn(
        "t", F.make_timestamp("year", "month", "day", "hour", F.lit(0), F.lit(0)))
    deliver(raw, "seq", str(tmp_path / "in"), 2)
    daily = rollup.daily_window(streams.files(spark, str(tmp_path / "in"), raw.schema, max_files=1), "t", "1 hour")
    got = runner.replay(daily.select("wsid", F.col("window.start").alias("day"), "high_temp"), "windowed")
    want = rollup.daily_window(raw, "t").select("wsid", F.col("window.start").alias("day"), "high_temp")
    newest = raw.agg(F.max("t")).first()[0]
    assert bag(got) == bag(want.where(F.date_add("day", 1) <= F.lit(newest) - F.expr("INTERVAL 1 HOUR")))


def test_duplicates_are_dropped(spark, tmp_path):
    df = spark.createDataFrame([(1, 10), (2, 11), (1, 12)], "id bigint, s bigint").withColumn("t", F.timestamp_seconds("s"))
    deliver(df, "s", str(tmp_path / "in"), 3)
    got = runner.replay(runner.deduplicated(streams.files(spark, str(tmp_path / "in"), df.schema, max_files=1), ["id"], "t",
                                            "1 minute"), "dedup")
    assert sorted(r.id for r in got.collect()) == [1, 2]


def test_lines_artifacts_and_results(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1,5\nbad\n")
    (tmp_path / "in" / "a.txt").write_text("9,9\n")
    lines = streams.watched_lines(spark, str(tmp_path / "in"))
    from tidegauge.functions import parse

    preds = parse.keep_valid(parse.parse_prediction(lines)).select("ride_id", "minutes")
    writer = results.to_topic(results.prediction_lines(preds), str(tmp_path / "cp"), path=str(tmp_path / "out"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["1,5"]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "x.pmml").write_text("<PMML/>")
    models = runner.replay(files.read_artifacts(spark, str(tmp_path / "m"), streaming=True), "models")
    assert [r.name for r in models.collect()] == ["x"]
    results.to_console(preds, str(tmp_path / "cp2"), discard=True).trigger(availableNow=True).start().awaitTermination()


def test_row_writer_and_points(spark, tmp_path):
    df = spark.range(6).withColumn("station", F.lit("S"))
    deliver(df, "id", str(tmp_path / "in"), 2)
    out = str(tmp_path / "rows")
    os.makedirs(out)

    def write(client, row):
        with open(f"{client}/{row.id}", "w"):
            pass

    stream = streams.files(spark, str(tmp_path / "in"), df.schema, max_files=1)
    q = stream.writeStream.foreach(points.RowWriter(lambda: out, write)).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert len(os.listdir(out)) == 6
    as_of = F.lit("2024-01-01 00:00:00").cast("timestamp")
    q = runner.start(stream, lambda b, i: points.append_points(timeseries.to_points(b, "m", ["station"], ["id"], as_of),
                                                             str(tmp_path / "p"), i),
                     str(tmp_path / "cp2"), "points", available_now=True)
    q.awaitTermination()
    assert points.read_points(spark, str(tmp_path / "p")).count() == 6


def test_daily_and_monthly_by_batches_with_a_repeated_batch(spark, tmp_path):
    from tidegauge.streaming import incremental

    raw = view(spark, SF_DIR, "weather_raw")
    deliver(raw, "seq", str(tmp_path / "in"), 5)
    daily = UpsertTable(spark, str(tmp_path / "daily"), ["wsid", "last_order"])
    monthly = UpsertTable(spark, str(tmp_path / "monthly"), ["wsid", "last_order"])
    to_monthly = incremental.monthly_change_batches(spark, str(tmp_path / "m"), monthly.write_batch)

    def write(closed, batch_id):
        daily.write_batch(closed, batch_id)
        to_monthly(spark.read.parquet(f"{daily.path}/batch={batch_id}"), batch_id)

    step = incremental.daily_change_batches(spark, str(tmp_path / "d"), write)

    def twice(batch, batch_id):
        step(batch, batch_id)
        if batch_id == 2:
            step(batch, batch_id)

    q = runner.start(streams.files(spark, str(tmp_path / "in"), raw.schema, max_files=1), twice, str(tmp_path / "cp"), "inc",
                     available_now=True)
    q.awaitTermination()
    want = rollup.daily_change(raw)
    same(daily.read(), want)
    same(monthly.read(), rollup.monthly_change(want))


def test_predictions_by_batches(spark, tmp_path):
    from tidegauge.streaming import incremental

    rides = view(spark, SF_DIR, "taxi_rides").withColumn("event_time", F.col("event_time").cast("timestamp"))
    deliver(rides, "event_time", str(tmp_path / "in"), 3)
    out = UpsertTable(spark, str(tmp_path / "out"), ["ride_id"])
    q = runner.start(streams.files(spark, str(tmp_path / "in"), rides.schema, max_files=1),
                     incremental.predict_batches(spark, str(tmp_path / "s"), out.write_batch), str(tmp_path / "cp"), "inc",
                     available_now=True)
    q.awaitTermination()
    assert bag(out.read()) == bag(taxi.predict(taxi.ride_features(rides)))


def test_stream_continues_a_stored_history(spark, tmp_path):
    raw = view(spark, SF_DIR, "weather_raw")
    history, later = raw.where("seq < 400"), raw.where("seq >= 400")
    deliver(later, "seq", str(tmp_path / "in"), 1)
    stream = change_rollup.daily_change_stream(streams.files(spark, str(tmp_path / "in"), raw.schema), history)
    got = runner.replay(stream, "continued")
    same(got.unionByName(rollup.daily_change(history)), rollup.daily_change(raw))


def test_one_read_of_all_batches(spark, tmp_path):
    """Batches after the snapshot are one scan; compaction keeps rows, and old folders go."""
    table = UpsertTable(spark, str(tmp_path / "t"), ["k", "year"], partitions=["year"], compact_every=4)
    for b in range(7):
        table.write_batch(spark.createDataFrame([(k, 2000 + k % 2, float(b)) for k in range(b, b + 3)],
                                                "k long, year int, v double"), b)
    rows = table.read()
    assert {r.k: r.v for r in rows.collect()} == {k: float(min(k, 6)) for k in range(9)}
    plan = rows.where("year = 2001")._jdf.queryExecution().toString()
    assert plan.count("FileScan parquet") <= 2 and "PartitionFilters: [isnotnull(year" in plan
    assert table._numbers("snapshot") == [3]
    table.vacuum()
    assert table._numbers("batch") == [4, 5, 6] and table.read().count() == 9


def test_batches_leave_no_runs_behind(spark, tmp_path):
    import os

    from tidegauge.streaming import incremental

    step = incremental.change_rollup_batches(spark, str(tmp_path), "wsid", "seq", ["day"], ["day"], [], {"total": "v"},
                                             lambda df, b: closed.extend(df.collect()))
    closed, rows = [], [(None if i % 3 == 0 else "a", i, None if i // 4 % 3 == 0 else i // 4 % 3, 1.0) for i in range(60)]
    for b in range(20):
        step(spark.createDataFrame(rows[3 * b:3 * b + 3], "wsid string, seq long, day int, v double"), b)
    assert [n for n in os.listdir(tmp_path) if n.startswith("runs")] == []
    from tidegauge.operators import rollup
    whole = rollup.change_rollup(spark.createDataFrame(rows, "wsid string, seq long, day int, v double"), "wsid", "seq",
                                 ["day"], ["day"], [], {"total": "v"})
    assert sorted(map(str, closed)) == sorted(map(str, whole.select(*closed[0].__fields__).collect()))


def test_missing_days_in_a_stream(spark, tmp_path):
    schema = "wsid string, seq long, day int, v double"
    rows = [(None if i % 4 == 0 else "a", None if i == 5 else i, None if i // 5 % 3 == 0 else i // 5 % 3,
             None if i < 12 else 1.0) for i in range(80)]
    for b in range(4):
        spark.createDataFrame(rows[20 * b:20 * b + 20], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    args = ("wsid", "seq", ["day"], ["day"], [rollup.Metric("v", "v")], {"total": "v"})
    stream = change_rollup.change_rollup_stream(streams.files(spark, str(tmp_path / "in"), schema, max_files=1), *args)
    got = runner.replay(stream, "missing")
    want = rollup.change_rollup(spark.createDataFrame(rows, schema), *args).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
