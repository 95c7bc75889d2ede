"""Every layout gives the same rows when keys, positions and triggers are missing."""

from collections import defaultdict
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import asof, ordered, rollup, taxi, training
from tidegauge.operators.blocks import ONE_BLOCK, BlockLayout, plan_blocks
from tidegauge.plans.common import rounded

N = 6000
FORCED = BlockLayout(0, 977, 7)
UNEVEN = BlockLayout(0, 0, 4, (500, 501, 4000), 1000, 7)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    keys = [None, "a", "b", "c"]
    out = []
    for i in range(N):
        seq = None if i % 97 == 0 else i
        day = None if rng.random() < 0.1 else int(i // 40 % 28)
        out.append((keys[rng.integers(4)], seq, 2020, 1, day, float(rng.integers(100)), i))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "wsid string, seq long, year int, month int, day int, temperature double, n long")


def layouts(df, order="seq"):
    return [ONE_BLOCK, plan_blocks(df, order), plan_blocks(df, order, min_rows=50), FORCED, UNEVEN]


def same(make, df):
    """The bag of rows under every layout, equal to that of one block."""
    found = [sorted(map(str, rounded(make(layout)).collect())) for layout in layouts(df)]
    assert all(f == found[0] for f in found[1:])
    return found[0]


def test_layouts_take_missing_positions(df):
    for layout in layouts(df):
        placed = layout.assign(df, "seq")
        assert placed.count() == N and placed.where("_block is null").count() == 0
        assert placed.where("seq is null and _block <> 0").count() == 0


def test_row_numbers(df, rows):
    order = [F.col("seq"), F.col("n")]
    same(lambda x: ordered.ordered_index(df.select("seq", "n"), order, "seq", layout=x), df)
    numbered = ordered.ordered_index(df.select("seq", "n"), order, "seq", layout=FORCED).orderBy("i").collect()
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[6]))
    assert [r.n for r in numbered] == [r[6] for r in want]


def test_change_runs(df, rows):
    metrics = [rollup.Metric("temp", "temperature")]
    make = lambda x: rollup.change_rollup(df, "wsid", "seq", ["day"], ["day"], metrics, {"total": "temperature"}, x)
    same(make, df)
    keyed = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[4] is not None, r[4] or 0)):
        keyed[r[0]].append(r)
    want = []
    for key, own in keyed.items():
        runs = [list(g) for _, g in groupby(own, key=lambda r: r[4])][:-1]
        want += [(str(key), g[0][4], sum(r[5] for r in g)) for g in runs]
    got = [(str(r.wsid), r.day, r.total) for r in make(UNEVEN).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("limit", [1000, 0])
def test_versions(spark, df, rows, limit):
    versions = [(k, v, f"{k}{v}") for k in ("a", "b", None) for v in (None, 0, 900, 901, 3000)]
    v = spark.createDataFrame(versions, "wsid string, at long, name string")
    for keys in (["wsid"], []):
        own = v if keys else v.where("wsid = 'a'")
        got = sorted(((r.n, r.name) for layout in (None, FORCED, UNEVEN) if limit == 0 or layout is None
                      for r in asof.asof_join(df, own, "seq", "at", ["name"], keys, max_broadcast=limit, layout=layout).collect()),
                     key=str)
        want = []
        for r in rows:
            valid = [x for x in versions if x[1] is not None and r[1] is not None and x[1] <= r[1]
                     and (x[0] == r[0] and r[0] is not None if keys else x[0] == "a")]
            want.append((r[6], max(valid, key=lambda x: x[1])[2] if valid else None))
        assert got == sorted(want * (1 if limit else 3), key=str)


def test_vectors_extracts_and_predictions(spark, df):
    same(lambda x: ordered.sliding_vector(df.withColumn("seq", F.coalesce("seq", -F.col("n"))).select("wsid", "seq", "temperature"),
                                          ["wsid"], "seq", "temperature", 4, layout=x), df)
    series = df.select(F.col("seq").alias("time"), F.col("n").alias("tie"), F.col("temperature").alias("utilization"),
                       F.lit(0).alias("class"))
    assert training.training_rows(series, "time", "tie").count() == N
    rides = df.select(F.col("n").alias("ride_id"), (F.col("n") % 2 == 0).alias("is_start"), F.timestamp_micros("seq").alias("event_time"),
                      (F.col("n") % 3).cast("int").alias("cell"), F.when(F.col("n") % 5 > 0, 1).alias("bucket"),
                      (F.col("temperature") + 1).alias("dist"), F.when(F.col("n") % 2 == 1, F.lit(5.0)).alias("minutes"))
    same(lambda x: taxi.predict(rides, x), df)
