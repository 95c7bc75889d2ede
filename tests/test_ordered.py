"""Order-dependent operators against plain Python, with blocks forced small."""

import random
import statistics as st

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import asof, blocks, ordered, rollup, taxi
from tidegauge.operators.blocks import BlockLayout, plan_blocks

LAYOUTS = [BlockLayout(0, 1, 1), BlockLayout(0, 7, 60), BlockLayout(0, 1, 400), BlockLayout(0, 50, 8),
           BlockLayout(0, 256, 4, (5, 100, 350), 64, 7)]  # unequal blocks


def test_layout_of_even_data_is_equal_width(spark):
    df = spark.range(20_000).select(F.col("id").alias("seq"))
    layout = plan_blocks(df, "seq", min_rows=100)
    assert not layout.splits and 60 <= layout.blocks <= 142
    n = layout.assign(df, "seq").groupBy("_block").count().agg(F.max("count"), F.count("*")).first()
    assert n[0] <= layout.width and n[1] == layout.blocks


def test_bursts_are_cut_finer(spark):
    # A third of the rows in one thousandth of the range, at the far end of a huge axis.
    spread = spark.range(10_000).select((F.col("id") * 1_000_000).alias("seq"))
    burst = spark.range(5_000).select((F.lit(9_999_999_000) + F.col("id")).alias("seq"))
    df = spread.union(burst)
    layout = plan_blocks(df, "seq", min_rows=100)
    assert layout.splits
    sizes = layout.assign(df, "seq").groupBy("_block").agg(
        F.count("*").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi")).orderBy("_block").collect()
    assert sum(r.n for r in sizes) == 15_000
    assert max(r.n for r in sizes) <= 2 * (15_000 // 100)
    assert all(a.hi < b.lo for a, b in zip(sizes, sizes[1:]))


def test_equal_positions_stay_together(spark):
    df = spark.range(9_000).select(F.when(F.col("id") < 3_000, 5).otherwise(F.col("id")).cast("bigint").alias("seq"))
    layout = plan_blocks(df, "seq", min_rows=100)
    got = layout.assign(df, "seq").where("seq = 5").select("_block").distinct().count()
    assert got == 1


def test_layout_of_nothing(spark):
    assert plan_blocks(spark.range(0).select(F.col("id").alias("seq")), "seq").single


def runs(records):
    """Closed runs of equal day per station, from (seq, wsid, year, month, day, value)."""
    out, open_run = [], {}
    for rec in sorted(records):
        run = open_run.setdefault(rec[1], [])
        if run and run[-1][4] != rec[4]:
            out.append(run)
            run = open_run[rec[1]] = []
        run.append(rec)
    return out


def weather(spark, records):
    df = spark.createDataFrame(records, "seq bigint, wsid string, year int, month int, day int, temperature double")
    t = F.col("temperature")
    return df.select("*", (t / 2).alias("wind_speed"), F.when(t > 20, t).otherwise(0.0).alias("pressure"),
                     F.lit(0.5).alias("one_hour_precip"))


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("stay", [0.0, 0.6, 0.97])
def test_change_rollup_equals_loop(spark, layout, stay):
    rng = random.Random(int(stay * 100))
    day = {"A": 1, "B": 1, "C": 1}
    records = []
    for seq in range(400):
        w = rng.choice("AAAAAAABBC") if seq else "C"  # one hot station, one rare
        if rng.random() > stay:
            day[w] = rng.choice([1, 2, 3])
        records.append((seq, w, 2008, rng.randint(1, 12), day[w], float(rng.randint(0, 40))))
    got = {(r.wsid, r.last_order): r for r in rollup.daily_change(weather(spark, records), layout=layout).collect()}
    want = runs(records)
    assert len(got) == len(want)
    for run in want:
        r, values = got[run[-1][1], run[-1][0]], [x[5] for x in run]
        assert (r.month, r.day) == run[-1][3:5]
        assert (r.high_temp, r.low_temp) == (max(values), min(values))
        assert r.variance_temp == pytest.approx(st.pvariance(values)) and r.stdev_temp == pytest.approx(st.pstdev(values))
        assert r.precip == pytest.approx(0.5 * len(run))
        high = [v for v in values if v > 20]
        assert r.mean_pressure == (pytest.approx(st.mean(high)) if high else None)


def test_only_the_day_number_is_compared(spark):
    records = [(0, "A", 2008, 1, 5, 1.0), (1, "A", 2008, 2, 5, 3.0), (2, "A", 2008, 2, 6, 9.0)]
    (r,) = rollup.daily_change(weather(spark, records)).collect()
    assert (r.month, r.day, r.mean_temp) == (2, 5, 2.0)
    by_date = rollup.daily_change(weather(spark, records), trigger=["year", "month", "day"]).collect()
    assert sorted((r.month, r.mean_temp) for r in by_date) == [(1, 1.0), (2, 3.0)]


def test_monthly_uses_daily_means(spark):
    records = [(0, "A", 2008, 1, 1, 2.0), (1, "A", 2008, 1, 1, 4.0), (2, "A", 2008, 1, 2, 9.0),
               (3, "A", 2008, 2, 3, 1.0), (4, "A", 2008, 2, 4, 1.0)]
    daily = rollup.daily_change(weather(spark, records))
    (r,) = rollup.monthly_change(daily).collect()
    assert (r.month, r.mean_temp, r.high_temp, r.high_precip) == (1, 6.0, 9.0, 1.0)


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("width", [1, 3, 5])
def test_sliding_vector_equals_loop(spark, layout, width):
    rng = random.Random(width)
    rows = [(i, rng.choice("xxxxxy" if i % 50 else "z"), float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "seq bigint, k string, v double")
    want, seen = {}, {}
    for seq, k, v in rows:
        seen.setdefault(k, []).append(v)
        if len(seen[k]) >= width:
            want[seq] = seen[k][-width:]
    got = {r.seq: r.vec for r in ordered.sliding_vector(df, ["k"], "seq", "v", width, layout=layout).collect()}
    assert got == want
    kept = ordered.sliding_vector(df, ["k"], "seq", "v", width, layout=layout, keep_short=True).collect()
    assert {r.seq: r.vec for r in kept} == {s: want.get(s) for s, _, _ in rows}


@pytest.mark.parametrize("layout", [None, *LAYOUTS])
@pytest.mark.parametrize("limit", [0, 1000])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_asof_equals_loop(spark, layout, limit, keys):
    rng = random.Random(3)
    data = [(i, rng.choice("aaaab")) for i in range(400)]
    versions = sorted({(rng.randint(0, 420), rng.choice("abc")) for _ in range(30)})
    versions = [(s, k, f"v{s}{k}") for s, k in versions if keys or (s, "a") not in versions or k == "a"]
    d = spark.createDataFrame(data, "seq bigint, k string")
    v = spark.createDataFrame(versions, "at bigint, k string, model string")
    v = v if keys else v.drop("k")
    got = {r.seq: r.model for r in asof.asof_join(d, v, "seq", "at", ["model"], keys, limit, layout).collect()}
    for seq, k in data:
        old = [(s, m) for s, vk, m in versions if s <= seq and (not keys or vk == k)]
        best = max(old)[0] if old else None
        assert got[seq] in ([m for s, m in old if s == best] if old else [None])
    assert len(got) == len(data)


def test_bunched_versions_leave_the_broadcast_plan(spark):
    d = spark.range(3000).select(F.col("id").alias("seq"))
    v = spark.range(1000).select((F.col("id") + F.when(F.col("id") > 900, 10 ** 9).otherwise(0)).alias("at"),
                                 F.concat(F.lit("v"), F.col("id")).alias("model"))
    got = asof.asof_join(d, v, "seq", "at", ["model"])
    assert "BroadcastHashJoin [_s" not in got._jdf.queryExecution().simpleString()
    assert got.where("seq = 2999").first().model == "v900" and got.count() == 3000


def test_settings_default(spark):
    requests = spark.createDataFrame([(1, "a"), (5, "a"), (9, "a"), (9, "b")], "seq bigint, k string")
    control = spark.createDataFrame([(4, "a", -1), (8, "a", 70)], "at bigint, k string, tmout bigint")
    got = asof.control_asof(requests, control, "seq", "at", ["k"], "tmout").collect()
    assert sorted((r.seq, r.k, r.tmout) for r in got) == [(1, "a", 100), (5, "a", 100), (9, "a", 70), (9, "b", 100)]


@pytest.mark.parametrize("layout", [None, *LAYOUTS])
def test_row_numbers(spark, layout):
    rows = [(random.Random(i).randint(0, 300), i) for i in range(400)]
    df = spark.createDataFrame(rows, "t bigint, id bigint")
    got = ordered.ordered_index(df, [F.col("t"), F.col("id")], "t", layout=layout).collect()
    assert [(r.t, r.id) for r in sorted(got, key=lambda r: r.i)] == sorted(rows)
    assert sorted(r.i for r in got) == list(range(1, 401))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_prediction_equals_loop(spark, layout):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        start = rng.random() < 0.6
        rows.append((i, start, rng.randint(0, 390), rng.choice([1, 1, 1, 2]), 0, rng.uniform(1, 5),
                     None if start else rng.uniform(3, 60)))
    df = spark.createDataFrame(rows, "ride_id bigint, is_start boolean, at bigint, cell int, bucket int, dist double, minutes double")
    df = df.withColumn("event_time", F.timestamp_micros("at")).drop("at")
    sums, want = {}, {}
    for ride, start, _, cell, _, x, y in sorted(rows, key=lambda r: (r[2], not r[1], r[0])):
        n, sxy, sxx = sums.get(cell, (0, 0.0, 0.0))
        if not start:
            sums[cell] = (n + 1, sxy + x * y, sxx + x * x)
        elif n >= 2:
            want[ride] = int(sxy / sxx * x)
    assert {r.ride_id: r.minutes for r in taxi.predict(df, layout).collect()} == want


def test_first_two_rides_are_not_predicted(spark):
    df = spark.createDataFrame([(1, False, 1, 2.0, 10.0), (2, True, 2, 2.0, None), (3, False, 3, 1.0, 5.0), (4, True, 4, 3.0, None)],
                               "ride_id bigint, is_start boolean, at bigint, dist double, minutes double")
    df = df.select("*", F.timestamp_micros("at").alias("event_time"), F.lit(1).alias("cell"), F.lit(0).alias("bucket"))
    assert [(r.ride_id, r.minutes) for r in taxi.predict(df).collect()] == [(4, 15)]


def test_rollup_of_union_equals_merge(spark):
    from tidegauge.streaming.change_rollup import merge, moments
    import numpy as np

    rng = np.random.default_rng(1)
    a, b = rng.normal(1000, 3, 50), rng.normal(5, 1, 30)
    m = merge(moments(a), moments(b))
    both = np.concatenate([a, b])
    assert m["n"] == 80 and m["mean"] == pytest.approx(both.mean()) and m["m2"] / 80 == pytest.approx(both.var())
    assert merge(moments(a), moments(np.array([]))) == moments(a)


def test_block_column_is_internal(spark):
    df = spark.range(10).select(F.col("id").alias("seq"), F.lit("k").alias("k"), F.lit(1.0).alias("v"))
    assert ordered.sliding_vector(df, ["k"], "seq", "v", 2).columns == ["seq", "k", "v", "vec"]
    assert blocks.BLOCK not in ordered.ordered_index(df, [F.col("seq")], "seq").columns


def test_stored_order_spreads_a_hot_key(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    out = ordered.stored_order(df, ["k"], ["t"], 4)
    parts = out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    assert len(parts) == 4 and max(p.n for p in parts) < 2500
    assert out.first().t == 3999
