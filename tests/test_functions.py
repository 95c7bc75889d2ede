"""Hand-computed values of the scalar functions and parsers."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import geo, parse, scalar


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def f32(x):
    return F.lit(x).cast("float")


def test_city_box_rejects_only_when_both_are_out(spark):
    lon_out, lat_out = one(spark, geo.in_city(f32(-70.0), f32(40.7)), geo.in_city(f32(-73.9), f32(45.0)))
    assert lon_out and lat_out
    both, strict = one(spark, geo.in_city(f32(-70.0), f32(45.0)), geo.in_city(f32(-70.0), f32(40.7), strict=True))
    assert not both and not strict


def test_grid_cells_are_not_clamped(spark):
    first, below, outside = one(spark, geo.grid_cell(f32(-74.0495), f32(40.9995)),
                                geo.grid_cell(f32(-74.0495), f32(40.9980)), geo.grid_cell(f32(-74.06), f32(40.9995)))
    assert (first, below) == (0, 250)
    assert outside < 0


def test_cell_center(spark):
    lon, lat = one(spark, geo.cell_center_lon(F.lit(251)), geo.cell_center_lat(F.lit(251)))
    assert lon == pytest.approx(-(74.05 - 0.0014 - 0.0007), abs=1e-5)
    assert lat == pytest.approx(41 - 0.00125 - 0.000625, abs=1e-5)


def test_cosine_takes_degrees(spark):
    (d,) = one(spark, geo.distance_km(f32(1.0), f32(0.0), f32(0.0), f32(60.0)))
    assert d == pytest.approx(110.25 * math.hypot(60, math.cos(60)), rel=1e-9)


@pytest.mark.parametrize("dlat,dlon,angle", [(0.0, 1.0, 179), (1.0, 0.0, 269), (-1.0, 0.0, 89), (0.0, -1.0, 359)])
def test_angle_and_bucket(spark, dlat, dlon, angle):
    a = geo.direction_angle(f32(0.0), f32(0.0), f32(dlon), f32(dlat))
    got, bucket = one(spark, a, geo.direction_bucket(a))
    assert (got, bucket) == (angle, angle // 45)


def test_smallest_angle_truncates_to_bucket_zero(spark):
    (b,) = one(spark, geo.direction_bucket(F.lit(-1)))
    assert b == 0


def test_path_has_one_cell_per_step(spark):
    lon1, lat1, lon2, lat2 = -74.0493, 40.9994, -74.0493 + 4 * 0.0014, 40.9994 - 2 * 0.00125
    (p,) = one(spark, geo.path_cells(f32(lon1), f32(lat1), f32(lon2), f32(lat2)))
    assert len(p) == 5 and p[0] == 0 and p[-1] == 4 + 2 * 250
    assert [c % 250 for c in p] == [0, 1, 2, 3, 4]


def test_argmax_takes_the_first_maximum(spark):
    tie, last = one(spark, scalar.argmax(F.array(F.lit(2.0), F.lit(2.0))), scalar.argmax(F.array(F.lit(1.0), F.lit(2.0))))
    assert (tie, last) == (0, 1)


def test_standardise_is_single_precision(spark):
    (z,) = one(spark, scalar.standardize(F.lit(0.5), 0.34964777, 0.18103937))
    assert z == pytest.approx((0.5 - 0.34964777) / 0.18103937, rel=1e-6)


def test_tags_and_keys(spark):
    row = one(spark, scalar.class_to_tag(F.lit(0)), scalar.class_to_tag(F.lit(2)), scalar.tag_to_class(F.lit("NORMAL")),
              scalar.tag_to_class(F.lit("x")), scalar.default_key(F.lit("")), scalar.default_key(F.lit("cpu7")),
              scalar.model_key(F.lit("a b c")))
    assert tuple(row) == ("normal", "anomaly", 0, 1, "cpu", "cpu7", "a_b_c")


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_weather_record(spark):
    rows = parse.parse_weather(lines(
        spark, "900017:00042,2019,7,3,12,18.5,9.25,998.5,135,6.5,4,0.5,1.5", "900017:00042,2019,7", "a,b,c,d,e,f,g,h,i,j,k,l,m"))
    good, bad = parse.split_bad(rows)
    r = good.first()
    assert (r.wsid, r.pressure, r.wind_direction, r.sky_condition_text) == ("900017:00042", 998.5, 135, "")
    assert bad.count() == 2


def test_taxi_end_records_swap_times(spark):
    start, end = "2013-01-01 00:00:00", "2013-01-01 00:10:00"
    rows = {r.is_start: r for r in parse.keep_valid(parse.parse_taxi(lines(
        spark, f"1,START,{start},{end},-73.9,40.7,-73.8,40.8,2", f"1,END,{end},{start},,40.7,-73.8,40.8,2"))).collect()}
    for r in rows.values():
        assert r.start_t == dt.datetime(2013, 1, 1) and r.end_t == dt.datetime(2013, 1, 1, 0, 10)
    assert rows[True].event_time == rows[True].start_t and rows[False].event_time == rows[False].end_t
    assert rows[False].start_lon == 0.0


@pytest.mark.parametrize("bad", ["1,START", "1,PAUSE,2013-01-01 00:00:00,2013-01-01 00:00:00,1,1,1,1,1",
                                 "x,START,2013-01-01 00:00:00,2013-01-01 00:00:00,1,1,1,1,1",
                                 "1,START,yesterday,2013-01-01 00:00:00,1,1,1,1,1"])
def test_bad_taxi_records_are_set_aside(spark, bad):
    good, rejected = parse.split_bad(parse.parse_taxi(lines(spark, bad)))
    assert good.count() == 0 and rejected.count() == 1


def test_wine_record_drops_the_label(spark):
    r = parse.parse_wine(lines(spark, "7.4;0.7;0;1.9;0.076;11;34;0.9978;3.51;0.56;9.4;5")).first()
    assert [r[c] for c in parse.WINE_FEATURES] == [7.4, 0.7, 0.0, 1.9, 0.076, 11.0, 34.0, 0.9978, 3.51, 0.56, 9.4]
    assert r.data_type == "wine" and r.is_valid


def test_properties(spark):
    df = spark.createDataFrame([("r", "# c"), ("r", " b = 2=3 "), ("r", "a=1"), ("r", "junk")], "run string, value string")
    r = parse.parse_properties(df).first()
    assert r.props == {"a": "1", "b": "2=3"} and r.suffix == "12=3"


def test_functions_by_name_equal_columns(spark):
    from tidegauge.functions import geo, sql

    sql.register(spark)
    df = spark.range(500).selectExpr("cast(-74.3 + id / 700 as float) as x1", "cast(40.3 + id % 97 / 120 as float) as y1",
                                     "cast(-73.9 - id % 31 / 90 as float) as x2", "cast(40.9 - id % 53 / 80 as float) as y2",
                                     "cast(id * 131 as int) as cell", "cast(id % 360 as int) as angle")
    pairs = {"grid_cell(x1, y1)": geo.grid_cell("x1", "y1"), "in_city(x1, y1)": geo.in_city("x1", "y1"),
             "in_city_strict(x1, y1)": geo.in_city("x1", "y1", strict=True), "cell_center_lon(cell)": geo.cell_center_lon("cell"),
             "cell_center_lat(cell)": geo.cell_center_lat("cell"), "direction_bucket(angle)": geo.direction_bucket("angle"),
             "direction_angle(x1, y1, x2, y2)": geo.direction_angle("x1", "y1", "x2", "y2"),
             "distance_km(x1, y1, x2, y2)": geo.distance_km("x1", "y1", "x2", "y2")}
    for text, column in pairs.items():
        assert df.where(~F.expr(text).eqNullSafe(column)).count() == 0, text


def test_shared_folder(spark):
    from types import SimpleNamespace

    from tidegauge.session import fits_broadcast, shared_dir

    def session(**conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k.replace(".", "_"), d)),
                               sparkContext=SimpleNamespace(applicationId="none"))

    assert shared_dir(session(spark_checkpoint_dir="s3a://x/"), "n").startswith("s3a://x/n-")
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_dir(session(spark_master=master), "n")
    with pytest.raises(RuntimeError):
        shared_dir(session(spark_master="local[4]"), "n", allow_local=False)
    df = spark.range(100).selectExpr("id", "repeat('x', 1000) as s")
    assert fits_broadcast(df, 100) and not fits_broadcast(df, 99) and not fits_broadcast(df, 100, 100_000)
