"""Streams out of order, online scoring and models that arrive in a stream."""

import json
import os
import random

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidegauge import plans
from tidegauge.operators import dispatch, ordered, scoring
from tidegauge.plans import model_specs as specs
from tidegauge.plans import streams as replays
from tidegauge.sources import streams
from tidegauge.streaming import model_join, model_stream, online, reorder, runner, voting


def feed(rows, schema, spark, path, first=0):
    """One file per list of rows, with rising modification times."""
    os.makedirs(path, exist_ok=True)
    for i, part in enumerate(rows, first):
        pq.write_table(spark.createDataFrame(part, schema).toArrow(), f"{path}/{i:04d}.parquet")
        os.utime(f"{path}/{i:04d}.parquet", (1_600_000_000 + i, 1_600_000_000 + i))


SAMPLE = "k string, seq bigint, t timestamp, v double"


def late(rng, rows, delay, files):
    """Rows of (k, seq, seconds, v) by arrival, each up to `delay` seconds late, some exactly so."""
    arrived = sorted(rows, key=lambda r: (r[2] + rng.choice([0, rng.uniform(0, delay), delay]), rng.random()))
    step = -(-len(arrived) // files)
    return [arrived[i:i + step] for i in range(0, len(arrived), step)]


def stamped(rows):
    return [(k, s, None if t is None else pd.Timestamp(1_700_000_000 + t, unit="s").to_pydatetime(), v) for k, s, t, v in rows]


@pytest.mark.parametrize("files,keys", [(2, 1), (7, 3), (25, 2)])
def test_events_out_of_order_give_the_batch_rows(spark, tmp_path, files, keys):
    rng = random.Random(files)
    rows = [(f"k{i % keys}", i, i * 2, float(i)) for i in range(300)]
    parts = late(rng, rows, 60, files) + [[("end", 10_000, 100_000, 0.0)]]
    assert any(a[1] > b[1] for p in parts for a, b in zip(p, p[1:]))
    schema = SAMPLE
    half = len(parts) // 2
    feed([stamped(p) for p in parts[:half]], schema, spark, str(tmp_path / "in"))

    def run():
        df = streams.files(spark, str(tmp_path / "in"), schema, max_files=1)
        return runner.replay(online.sliding_vector_stream(df, "k", "seq", "v", 4, time="t"), "late",
                             checkpoint=str(tmp_path / "cp"), path=str(tmp_path / "out"))

    run()
    feed([stamped(p) for p in parts[half:]], schema, spark, str(tmp_path / "in"), half)  # after a restart
    got = sorted((r.k, r.seq, list(r.vec)) for r in run().collect())
    batch = ordered.sliding_vector(spark.createDataFrame([(k, s, v) for k, s, _, v in rows], "k string, seq bigint, v double"),
                                   ["k"], "seq", "v", 4)
    assert got == sorted((r.k, r.seq, list(r.vec)) for r in batch.collect())


def test_rows_without_a_time_and_rows_too_late(spark, tmp_path):
    parts = [[("a", 1, 0, 1.0), ("a", 0, None, 9.0)], [("a", 2, 200, 2.0)], [("a", 3, 10, 7.0), ("a", 4, 201, 3.0)],
             [("end", 5, 9_000, 0.0)]]
    feed([stamped(p) for p in parts], SAMPLE, spark, str(tmp_path / "in"))
    df = streams.files(spark, str(tmp_path / "in"), SAMPLE, max_files=1)
    got = runner.replay(online.sliding_vector_stream(df, "k", "seq", "v", 1, time="t"), "late")
    # The row of 10 s is 190 s late, more than the delay: it may be dropped, all others are there.
    assert {0, 1, 2, 4} <= {r.seq for r in got.collect()} <= {0, 1, 2, 3, 4}


def bunched_events(spark, path, n=1_500):
    """Events of few keys, most of them in the first two hours of a month."""
    rng = random.Random(6)
    seconds = sorted([rng.uniform(0, 7_200) for _ in range(n * 9 // 10)] + [rng.uniform(0, 2_500_000) for _ in range(n // 10)])
    rows = [(i, pd.Timestamp(1_704_067_200 + t, unit="s").floor("us").to_pydatetime(), rng.choice([1, 1, 1, 2, 10, 15]), "view",
             round(rng.uniform(0, 200), 2), "") for i, t in enumerate(seconds)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{path}/events.parquet")
    return n


@pytest.mark.parametrize("name,batch", [("stream_late_daily", "daily_change"), ("stream_late_slide", "slide_vec")])
def test_late_replays_bound_what_waits_in_state(spark, tmp_path, monkeypatch, name, batch):
    """Whatever the size of the table, a micro-batch has a bounded number of rows; the rows are those of the batch form."""
    n, queries = bunched_events(spark, str(tmp_path)), plans.all_queries()
    started, plain = [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **k: started.append(plain(self, *a, **k)) or started[-1])
    monkeypatch.setattr(replays, "_WAITING", 400, raising=False)
    got = queries[name](spark, str(tmp_path))
    sizes = [p.numInputRows for p in started[0].recentProgress]
    assert sum(sizes) == n + 1 and max(sizes) <= 600
    want = queries[batch](spark, str(tmp_path)).select(*got.columns)
    assert want.count() > 50 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


MODELS = "data_type string, seq bigint, model string, model_type string, data binary, width int, mean double, std double"
SAMPLES = "data_type string, seq bigint, utilization double, class int"


def logistic(weights, intercept):
    return json.dumps({"weights": weights, "intercept": intercept}).encode()


def plain_serving(samples, models):
    """The model in force, its own window and its decision, sample by sample."""
    out, state = [], {}
    for key, seq, u, cls, model in sorted([(*s, None) for s in samples] + [(m[0], m[1], None, None, m) for m in models],
                                          key=lambda r: (r[1], r[4] is None)):
        if model is not None:
            if model[3] == "logistic" and model[4] != b"broken":
                state[key] = (model, [])
            continue
        if key not in state:
            out.append((key, seq, False, None, cls, None))
            continue
        (_, _, name, _, data, width, mean, std), ring = state[key]
        ring.append(np.float32((u - mean) / std))
        del ring[:-width]
        p = json.loads(data)
        total = sum(float(z) * w for z, w in zip(ring, p["weights"])) + p["intercept"]
        out.append((key, seq, True, name, cls, int(total > 0) if len(ring) == width else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("files", [1, 3, 10])
def test_online_scoring_with_swaps_and_a_restart(spark, tmp_path, files):
    rng = random.Random(files)
    samples = [(f"cpu{rng.randrange(3)}", i * 2, rng.random(), rng.randrange(2)) for i in range(240)]
    weights = [rng.uniform(-1, 1) for _ in range(5)]
    models = [("cpu0", 41, "a", "logistic", logistic(weights, 0.1), 5, 0.5, 0.2),
              ("cpu0", 200, "b", "logistic", logistic(weights[:3], -0.1), 3, 0.4, 0.3),
              ("cpu0", 260, "c", "logistic", b"broken", 3, 0.4, 0.3), ("cpu0", 270, "d", "unknown", b"", 3, 0.4, 0.3),
              ("cpu1", 0, "e", "logistic", logistic(weights, 0.0), 5, 0.5, 0.2), ("cpu1", 300, "a", "logistic", logistic(weights, 0.1), 5, 0.5, 0.2)]
    step = 480 // files + 1
    cut = lambda rows: [[r for r in rows if i * step <= r[1] < (i + 1) * step] for i in range(files)]
    src, mod = str(tmp_path / "s"), str(tmp_path / "m")

    def run():
        served = online.serve_stream(streams.files(spark, src, SAMPLES, max_files=1), streams.files(spark, mod, MODELS, max_files=1),
                                     "seq", ["data_type", "seq"])
        return runner.replay(served, "online", checkpoint=str(tmp_path / "cp"), path=str(tmp_path / "out"))

    half = files // 2
    for rows, schema, path in ((samples, SAMPLES, src), (models, MODELS, mod)):
        feed(cut(rows)[:half], schema, spark, path)
    if half:
        run()
    for rows, schema, path in ((samples, SAMPLES, src), (models, MODELS, mod)):
        feed(cut(rows)[half:], schema, spark, path, half)
    got = run()
    assert sorted(((r.data_type, r.seq, r.processed, r.model, r.source, r.result) for r in got.collect()), key=str) == plain_serving(
        samples, models)
    # Statistics of the durations: every served sample counts, none takes no time.
    stats = {(r.data_type, r.model): r for r in scoring.serving_stats(got.where("processed"), ["data_type", "model"], "duration",
                                                                      "seq").collect()}
    assert sum(r.usage for r in stats.values()) == got.where("processed").count()
    assert all(0 < r.min_duration <= r.max_duration < r.duration + 1 for r in stats.values())


def wine_rows(spark, n=400):
    fields = ["fixed_acidity", "volatile_acidity", "citric_acid", "residual_sugar", "chlorides", "free_sulfur_dioxide",
              "total_sulfur_dioxide", "density", "ph", "sulphates", "alcohol"]
    rng = random.Random(1)
    rows = [(i, *[None if rng.random() < 0.05 else rng.uniform(0, 12) for _ in fields]) for i in range(n)]
    return spark.createDataFrame(rows, "seq bigint, " + ", ".join(f"{f} double" for f in fields)).repartition(5)


FAMILIES = {"linear": specs.linear_pmml, "gauss": lambda: specs.general_pmml(specs.GAUSSIAN, "normal"),
            "gamma": lambda: specs.general_pmml(specs.GAMMA, "gamma"), "tree": lambda: specs.tree_pmml(4, 1, "reg"),
            "class": lambda: specs.tree_pmml(5, 2, "cls"), "forest": lambda: specs.forest_pmml(7, 4), "mlp": specs.network_pmml,
            "predicates": specs.predicate_pmml}


@pytest.mark.parametrize("max_bytes", [1 << 26, 0])
def test_models_as_data_score_as_expressions_do(spark, max_bytes):
    rows = wine_rows(spark)
    names = [*FAMILIES, "broken", "unknown"]
    keyed = rows.withColumn("digest", F.element_at(F.array(*[F.lit(n) for n in names], F.lit(None).cast("string")),
                                                   (F.col("seq") % (len(names) + 1) + 1).cast("int")))
    models = spark.createDataFrame([(n, "PMML", f().encode()) for n, f in FAMILIES.items()] + [("broken", "PMML", b"<PMML")],
                                   "digest string, model_type string, data binary")
    models = models.unionByName(models)  # a model may be published twice
    got = {r.seq: r.score for r in dispatch.score_by_digest(keyed, models, max_bytes=max_bytes, part_rows=7).collect()}
    assert len(got) == rows.count()
    for n, f in FAMILIES.items():
        want = {r.seq: r.score for r in scoring.score(keyed.where(F.col("digest") == n), "PMML", f().encode()).collect()}
        assert {s: got[s] for s in want} == pytest.approx(want, nan_ok=True)
    rest = {r.seq for r in keyed.where("digest is null or digest in ('broken', 'unknown')").collect()}
    assert rest and all(got[s] is None for s in rest)


def test_a_row_is_evaluated_by_its_own_model_only(spark):
    seen = spark.sparkContext.accumulator(0)

    def factory(data):
        def run(x):
            seen.add(len(x))
            return x[:, 0] + float(data)
        return dispatch.VectorModel(["v"], run)

    rows = spark.range(1000).select(F.col("id").cast("double").alias("v"), F.concat(F.lit("m"), F.col("id") % 4).alias("model"),
                                    F.lit(None).cast("double").alias("score"))
    models = {f"m{i}": ("probe", str(i).encode()) for i in range(3)}
    out = dispatch.score_rows(rows, models, "model", "score", {"probe": factory}).collect()
    assert seen.value == 750
    assert all(r.score == (None if r.v % 4 == 3 else r.v + r.v % 4) for r in out)


def test_forests_in_a_registry_are_evaluated_for_their_rows(spark):
    rows = wine_rows(spark).withColumn("model", F.when(F.col("seq") % 3 == 0, "forest").when(F.col("seq") % 3 == 1, "linear"))
    registry = [("forest", "PMML", FAMILIES["forest"]().encode()), ("linear", "PMML", FAMILIES["linear"]().encode())]
    scored = scoring.score_dispatch(rows, registry)
    assert "ArrowEvalPython" not in scored._jdf.queryExecution().executedPlan().toString()
    got = {r.seq: r.score for r in scored.collect()}
    for i, name in enumerate(("forest", "linear")):
        want = {r.seq: r.score for r in scoring.score(rows.where(F.col("seq") % 3 == i), "PMML", FAMILIES[name]().encode()).collect()}
        assert {s: got[s] for s in want} == pytest.approx(want)
    assert all(got[s] is None for s in got if s % 3 == 2)


def test_compiled_models_are_kept_and_bounded(monkeypatch):
    monkeypatch.setattr(dispatch, "CACHED", 2)
    dispatch.worker_cache("models").clear()
    a, b, c = (logistic([w], 0.0) for w in (1.0, 2.0, 3.0))
    first = dispatch.compiled("logistic", a)
    assert dispatch.compiled("logistic", a) is first
    dispatch.compiled("logistic", b), dispatch.compiled("logistic", a), dispatch.compiled("logistic", c)
    assert len(dispatch.worker_cache("models")) == 2 and dispatch.compiled("logistic", a) is first
    assert dispatch.compiled("logistic", b"broken") is None and dispatch.compiled("x", b"") is None


def test_a_repeated_batch_of_models_changes_nothing(spark, tmp_path):
    store = model_stream.ModelStore(spark, str(tmp_path / "store"), ["data_type"], "seq")
    models = spark.createDataFrame([("w", 1, "a", "PMML", specs.linear_pmml().encode()), ("w", 2, "b", "PMML", b"<PMML")],
                                   "data_type string, seq bigint, model string, model_type string, data binary")
    for _ in range(2):
        store.write_batch(models, 0)
    store.write_batch(models.withColumn("seq", F.col("seq") + 10), 1)
    assert [(r.seq, r.model) for r in store.versions(0).collect()] == [(1, "a")]
    assert sorted(r.seq for r in store.versions(1).collect()) == [1, 11]
    assert store.models(1, store.versions(1).select("digest").distinct()).select("digest").distinct().count() == 1


def test_settings_of_a_stream_out_of_order(spark, tmp_path):
    q = "data_type string, seq bigint, t timestamp"
    c = "data_type string, seq bigint, t timestamp, tmout bigint"
    at = lambda s: pd.Timestamp(1_700_000_000 + s, unit="s").to_pydatetime()
    requests = [("a", s, at(s)) for s in range(0, 100, 10)] + [("b", 5, at(5))]
    controls = [("a", 25, at(25), 70), ("a", 55, at(55), -1), ("a", 75, at(75), 90)]
    # All settings come after the requests that they are for.
    feed([requests, [("end", 0, at(5_000))]], q, spark, str(tmp_path / "q"))
    feed([controls, [("end", 0, at(5_000), 1)]], c, spark, str(tmp_path / "c"))
    got = runner.replay(model_join.control_stream(
        streams.files(spark, str(tmp_path / "q"), q, max_files=1), streams.files(spark, str(tmp_path / "c"), c, max_files=1),
        "data_type", "seq", "tmout", time="t"), "control")
    want = {("a", s): 100 if s < 25 else 70 if s < 55 else 100 if s < 75 else 90 for s in range(0, 100, 10)} | {("b", 5): 100}
    assert {(r.data_type, r.seq): r.tmout for r in got.collect()} == want


VOTE_Q, VOTE_R = "request_id bigint, req_ts bigint", ("request_id bigint, resp_ts bigint, processed boolean, result int, source int")


@pytest.mark.parametrize("shares,own", [(1, False), (16, False), (5, True)])
def test_early_votes_in_shares(spark, tmp_path, shares, own):
    def unanimous_zero(responses):
        votes = [r[2] for r in responses if r[1]]
        return {"processed": bool(votes), "source": None, "result": int(any(votes)), "votes": len(votes)}

    decider, rng = unanimous_zero if own else voting.decide, random.Random(4)
    requests = [(i, 1_000_000 + i * 50) for i in range(200)]
    responses = [(i, ts + rng.randrange(160), rng.random() < 0.8, rng.choice([0, 1, None]), rng.randrange(2))
                 for i, ts in requests for _ in range(rng.randrange(5))]
    responses += [(5_000, 1_000_100, True, 1, 1)]  # a response to nothing
    close = [(-1, 9_000_000)], [(-1, 9_000_000, False, 0, 0)]
    by_time = sorted(responses, key=lambda r: r[1])
    feed([requests[:90], requests[90:], close[0]], VOTE_Q, spark, str(tmp_path / "q"))
    cut = [r for r in by_time if r[1] < requests[90][1]]
    feed([cut, by_time[len(cut):], close[1]], VOTE_R, spark, str(tmp_path / "r"))
    out = voting.vote_stream_early(streams.files(spark, str(tmp_path / "q"), VOTE_Q, max_files=1),
                                   streams.files(spark, str(tmp_path / "r"), VOTE_R, max_files=1), 3, 100, decider=decider, shares=shares)
    got = {r.request_id: tuple(r)[1:] for r in runner.replay(out, "early").collect() if r.request_id >= 0}
    for i, ts in requests:
        own = sorted(((r[1], *r[2:]) for r in responses if r[0] == i and ts <= r[1] <= ts + 100), key=lambda r: r[0])
        d = decider(own[:3])
        times = {own[2][0] - ts} if len(own) >= 3 else {100}
        if len(own) > 3 and own[2][0] == own[3][0]:
            continue  # which of two at one time is third is open
        assert got[i] == (d["processed"], d["source"], d["result"], d["votes"], *times), i
    assert len(got) == len(requests)


def test_blocks_keep_their_rows():
    rows = pd.DataFrame({"a": [1, 2], "b": [None, "x"], "t": pd.to_datetime([1, 2], unit="us"), "c": [np.nan, 1.5]})
    assert reorder.of_block(reorder.to_block(rows)).astype(object).where(rows.notna(), None).values.tolist() == rows.astype(
        object).where(rows.notna(), None).values.tolist()
