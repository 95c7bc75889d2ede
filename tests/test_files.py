"""File sources, tables, points and training sets."""

import datetime as dt
import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import timeseries
from tidegauge.plans import model_specs as specs
from tidegauge.sinks import points, results
from tidegauge.sinks.tables import UpsertTable, fan_out, metric_tables
from tidegauge.sources import files, wire


def test_lines_of_plain_gzip_and_zip(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1\n2\n")
    (tmp_path / "sub").mkdir()
    with gzip.open(tmp_path / "sub" / "b.csv.gz", "wt") as f:
        f.write("3\n")
    with zipfile.ZipFile(tmp_path / "c.csv.zip", "w") as z:
        z.writestr("x.csv", "4\r\n5\r\n")
        z.writestr("d/y.csv", "6")
    (tmp_path / "ignored.txt").write_text("7\n")
    assert sorted(r.value for r in files.read_lines(spark, str(tmp_path)).collect()) == list("123456")
    assert files.read_lines(spark, str(tmp_path / "a.csv")).count() == 2


def test_artifacts(spark, tmp_path):
    (tmp_path / "m1.pmml").write_text(specs.linear_pmml())
    (tmp_path / "note.txt").write_text("x")
    r = files.read_artifacts(spark, str(tmp_path)).collect()
    assert [(x.name, x.model_type) for x in r] == [("m1", "PMML")] and bytes(r[0].data).startswith(b"<PMML")


def test_stations(spark, tmp_path):
    (tmp_path / "s.csv").write_text("1:2,Name,US,OR,K1,45.5,-122.6,9\n")
    r = files.read_stations(spark, str(tmp_path)).first()
    assert (r.id, r.lat, r.elevation) == ("1:2", 45.5, 9.0)


def test_wire_round_trip_and_defaults(spark):
    pytest.importorskip("google.protobuf")
    df = spark.createDataFrame([("s", 2008, None, 5.5)], "wsid string, year int, month int, temperature double")
    others = {n: "none" for n, k, _ in wire.MESSAGES["WeatherRecord"] if n not in df.columns}
    df = df.withColumn("none", F.lit(None).cast("string"))
    sent = df.select(wire.to_wire(df, "WeatherRecord", others).alias("value"))
    r = wire.decode_weather(sent).first()
    assert (r.wsid, r.year, r.month, r.temperature, r.sky_condition_text) == ("s", 2008, 0, 5.5, "")


def rows(spark, *values):
    return spark.createDataFrame(values, "k string, year int, v int, seq int")


def test_upserts_are_repeatable_and_compact(spark, tmp_path):
    t = UpsertTable(spark, str(tmp_path / "t"), ["k", "year"], "seq", ["year"])
    t.write_batch(rows(spark, ("a", 1, 10, 1), ("b", 1, 20, 2), ("a", 1, 11, 3)), 0)
    t.write_batch(rows(spark, ("b", 1, 21, 1), ("c", 2, 30, 1)), 1)
    t.write_batch(rows(spark, ("b", 1, 22, 1), ("c", 2, 30, 1)), 1)  # the batch is repeated after a failure

    def now():
        return sorted((r.k, r.year, r.v) for r in t.read().collect())

    want = [("a", 1, 11), ("b", 1, 22), ("c", 2, 30)]
    assert now() == want
    assert t.compact() == 1
    assert now() == want
    t.vacuum()
    assert now() == want
    t.write_batch(rows(spark, ("a", 1, 12, 1)), 2)
    assert now() == [("a", 1, 12), ("b", 1, 22), ("c", 2, 30)]
    assert t.read().where("k = 'a'").count() == 1


def test_unfinished_batch_is_not_read(spark, tmp_path):
    t = UpsertTable(spark, str(tmp_path / "t"), ["k", "year"])
    t.write_batch(rows(spark, ("a", 1, 10, 1)), 0)
    (tmp_path / "t" / "batch=1").mkdir()
    assert t.read().count() == 1


def test_one_batch_fans_out_to_four_tables(spark, tmp_path):
    stats = [F.lit(1.0).alias(f"{s}_{m}") for m in ("temp", "wind", "pressure") for s in ("high", "low", "mean", "variance", "stdev")]
    daily = spark.range(2).select(F.concat(F.lit("S"), "id").alias("wsid"), F.lit(2008).alias("year"), F.lit(1).alias("month"),
                                  F.lit(2).alias("day"), *stats, F.lit(0.5).alias("precip"))
    seen = []
    write = fan_out(spark, str(tmp_path), "daily", also=lambda b, i: seen.append((b.count(), i)))
    write(daily, 0)
    write(daily, 0)
    for metric, t in metric_tables(spark, str(tmp_path), "daily").items():
        assert t.read().count() == 2
        assert ("precipitation" in t.read().columns) == (metric == "precip")
    assert seen == [(2, 0), (2, 0)]


def test_points_repeat_and_expire(spark, tmp_path):
    path = str(tmp_path / "p")

    def batch(day, n):
        return timeseries.to_points(spark.range(n).withColumn("station", F.lit("S")), "m", ["station"], {"value": "id"},
                                    F.lit(f"2024-01-0{day} 10:00:00").cast("timestamp"))

    points.append_points(batch(1, 3), path, 0)
    points.append_points(batch(2, 2), path, 1)
    points.append_points(batch(2, 2), path, 1)
    points.append_points(batch(3, 1), path, 2)
    assert points.read_points(spark, path).count() == 6
    assert points.read_points(spark, path).where("fields['value'] = 2").count() == 1
    assert points.expire(spark, path, dt.datetime(2024, 1, 3, 12)) == ["measurement=m/date=2024-01-01"]
    kept = timeseries.retain(points.read_points(spark, path), "time", F.lit("2024-01-03 12:00:00").cast("timestamp"))
    assert kept.count() == 1


def test_external_writes_are_batched(spark, tmp_path):
    out = str(tmp_path)

    def write(client, batch):
        import os
        with open(os.path.join(client, f"{batch[0].id}.txt"), "w") as f:
            f.write(str(len(batch)))

    points.write_external(spark.range(0, 25, 1, 2), lambda: out, write, size=10)
    sizes = sorted(int(p.read_text()) for p in tmp_path.glob("*.txt"))
    assert sum(sizes) == 25 and max(sizes) == 10


def test_training_set_is_gated_by_the_threshold(spark, tmp_path):
    root = str(tmp_path / "train")

    def series(n):
        i = F.col("id")
        return spark.range(n).select(F.timestamp_seconds(i * 60).alias("ts"), i.alias("seq"),
                                     (i / 10).alias("utilization"), (i % 2).cast("int").alias("class"))

    assert not results.write_training_set(series(5), root, "ts", "seq", threshold=8)
    assert results.read_mark(spark, root) is None and not (tmp_path / "train" / "complete").exists()
    assert spark.read.csv(f"{root}/data", header=True).count() == 5
    assert results.write_training_set(series(10), root, "ts", "seq", threshold=8)
    assert (tmp_path / "train" / "complete" / "_SUCCESS").exists()
    assert results.read_mark(spark, root) == "1970-01-01 00:09:00"
    assert not results.write_training_set(series(13), root, "ts", "seq", threshold=8)
    data = spark.read.csv(f"{root}/data", header=True)
    assert data.columns == ["Time", "CPU", "Class"]
    assert [(r.Time, r.CPU) for r in data.orderBy("Time").collect()] == [("1", "1.0"), ("2", "1.1"), ("3", "1.2")]
    assert results.read_mark(spark, root) == "1970-01-01 00:09:00"
