"""Voting, statistics, models and training."""

import json

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import pmml
from tidegauge.functions.parse import WINE_FEATURES
from tidegauge.operators import enrich, ensemble, scoring, training
from tidegauge.plans import model_specs as specs
from tidegauge.streaming import voting

RESPONSES = "request_id bigint, processed boolean, result int, source int"


@pytest.mark.parametrize("votes,result", [
    ([(True, 1), (True, 0)], 1),                      # exactly one half counts as 1
    ([(True, 1), (True, 0), (True, 0)], 0),
    ([(True, 1), (True, None), (True, None)], 0),     # no result votes 0
    ([(True, 1), (False, 0), (False, 0)], 1),         # not processed does not vote
    ([(False, 1)], None),
])
def test_vote(spark, votes, result):
    rows = [(7, p, v, 1) for p, v in votes]
    r = ensemble.vote(spark.createDataFrame(rows, RESPONSES)).first()
    assert (r.result, r.processed) == (result, result is not None)
    early = voting.decide([(0, p, v, 1) for p, v in votes])
    assert early["result"] == result


def test_votes_after_the_timeout_are_ignored(spark):
    requests = spark.createDataFrame([(1, 1000), (2, 1000), (3, 1000)], "request_id bigint, req_ts bigint")
    responses = spark.createDataFrame([
        (1, 1100, True, 1, 1), (1, 1101, True, 0, 1), (1, 1050, True, 1, 1),
        (2, 1010, True, 0, 0), (2, 1020, True, 0, 0), (2, 1030, True, 1, 0)],
        "request_id bigint, resp_ts bigint, processed boolean, result int, source int")
    got = {r.request_id: r for r in ensemble.vote_timeout(requests, responses, 100, 3).collect()}
    assert (got[1].votes, got[1].result, got[1].duration) == (2, 1, 100)
    assert (got[2].votes, got[2].result, got[2].duration) == (3, 0, 30)
    assert (got[3].processed, got[3].result, got[3].duration) == (False, None, 100)


def test_hot_request_is_divided(spark):
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        requests = spark.range(300).select(F.col("id").alias("request_id"), F.lit(1000).cast("bigint").alias("req_ts"))
        i = F.col("id")
        responses = spark.range(0, 30_000, 1, 8).select(
            F.when(i % 3 == 0, 7).otherwise(i % 300).cast("bigint").alias("request_id"), (i % 250 + 1000).alias("resp_ts"),
            F.lit(True).alias("processed"), (i % 2).cast("int").alias("result"), F.lit(1).alias("source"))
        got = ensemble.vote_timeout(requests, responses, 100, 3)
        votes = {r.request_id: r.votes for r in got.collect()}
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {}
    for n in range(30_000):
        if n % 250 <= 100:
            k = 7 if n % 3 == 0 else n % 300
            want[k] = want.get(k, 0) + 1
    # The first three responses decide, however many come in time.
    assert votes == {k: min(3, want.get(k, 0)) for k in range(300)}


def test_the_first_answers_decide(spark):
    requests = spark.createDataFrame([(1, 1000)], "request_id long, req_ts long")
    rows = [(1, 1050, True, 1, 4), (1, 1010, True, 0, 9), (1, 1020, True, 0, 2), (1, 1020, True, 1, 1), (1, 1200, True, 1, 1)]
    responses = spark.createDataFrame(rows, "request_id long, resp_ts long, processed boolean, result int, source int")
    got = {n: tuple(ensemble.vote_timeout(requests, responses, 100, n).first())[1:] for n in (2, 3, 4, 5)}
    assert got == {2: (True, 9, 1, 2, 20), 3: (True, 9, 0, 3, 20), 4: (True, 9, 1, 4, 50), 5: (True, 9, 1, 4, 100)}


def test_custom_decider(spark):
    rows = [(1, True, 1, 0), (1, True, 0, 0), (1, True, 0, 0)]
    unanimous_zero = F.max("result")
    assert ensemble.vote(spark.createDataFrame(rows, RESPONSES), decider=unanimous_zero).first().result == 1


def test_fanout_without_model_keeps_the_record(spark):
    data = spark.createDataFrame([(1, "a"), (2, "zz")], "seq int, data_type string")
    models = spark.createDataFrame([("m1", "a"), ("m2", "a"), ("m3", "aa")], "model string, data_type string")
    for limit in (0, 10):
        got = ensemble.fanout(data, models, max_broadcast=limit).collect()
        assert sorted((r.seq, r.model or "") for r in got) == [(1, "m1"), (1, "m2"), (2, "")]


def test_shortest_duration_is_a_true_minimum(spark):
    rows = spark.createDataFrame([("m", 5, 10), ("m", 9, 11)], "model string, ms int, at int")
    r = scoring.serving_stats(rows, ["model"], "ms", "at").first()
    assert (r.usage, r.duration, r.min_duration, r.max_duration, r.since) == (2, 14, 5, 9, 10)


def test_catalog_matches_the_exact_key(spark):
    models = spark.createDataFrame([("cpu", "m1"), ("cpu2", "m2"), ("cpu", "m1")], "data_type string, model string")
    assert [r.model for r in scoring.model_catalog(models, only="cpu").collect()] == ["m1"]


def test_lookup_plans_agree(spark):
    raw = spark.createDataFrame([(0,), (11,), (19,)], "sky_condition int")
    sky = enrich.sky_lookup(spark)
    assert sky.count() == 16
    for limit in (0, 100):
        anti = enrich.lookup(raw, sky, "sky_condition", "code", "left_anti", limit)
        assert [r.sky_condition for r in anti.collect()] == [11]


def wine(spark, n=200):
    i = F.col("id")
    return spark.range(n).select(i.alias("seq"), *[
        (F.lit(float(lo)) + (i * (7 + j) % 100) / 100 * (hi - lo)).alias(c)
        for j, (c, (lo, hi)) in enumerate(specs.RANGES.items())])


def test_missing_field_counts_as_zero(spark):
    df = spark.range(1).select(F.lit(10.0).alias("alcohol"), F.lit(None).cast("double").alias("sulphates"))
    r = scoring.score(df, "PMML", specs.linear_pmml().encode()).first()
    assert r.score == pytest.approx(specs.LINEAR[0] + 10 * specs.LINEAR[1]["alcohol"])


def test_links_and_powers(spark):
    import math

    spec = (0.5, {"alcohol": 0.25})
    df = spark.range(1).select(F.lit(2.0).alias("alcohol"))
    for link, want in (("log", math.exp(1.0)), ("logit", 1 / (1 + math.exp(-1.0))), ("identity", 1.0)):
        doc = pmml.Document(specs.general_pmml(spec, "normal", link))
        assert df.select(doc.score(df.columns)).first()[0] == pytest.approx(want)
    squared = specs.linear_pmml(spec).replace('coefficient="0.25"', 'coefficient="0.25" exponent="2"')
    assert df.select(pmml.Document(squared).score(df.columns)).first()[0] == pytest.approx(1.5)


@pytest.mark.parametrize("kind", ["reg", "cls"])
def test_large_tree_in_arrays_equals_expression(spark, monkeypatch, kind):
    df = wine(spark)
    doc = pmml.Document(specs.tree_pmml(5, 3, kind))
    expression = df.select("seq", doc.score(df.columns).alias("s"))
    monkeypatch.setattr(pmml, "MAX_EXPRESSION_LEAVES", 4)
    arrays = df.select("seq", doc.score(df.columns).alias("s"))
    assert "ArrowEvalPython" in arrays._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in expression._jdf.queryExecution().toString()
    assert sorted(map(tuple, expression.collect())) == sorted(map(tuple, arrays.collect()))


PREDICATES = {
    "<False/>": lambda x: False, "<True/>": lambda x: True,
    '<SimplePredicate field="a" operator="lessThan" value="2"/>': lambda x: x < 2,
    '<SimplePredicate field="a" operator="notEqual" value="2"/>': lambda x: x != 2,
    '<SimpleSetPredicate field="a" booleanOperator="isIn"><Array n="2" type="real">1 3</Array></SimpleSetPredicate>': lambda x: x in (1, 3),
    '<SimpleSetPredicate field="a" booleanOperator="isNotIn"><Array n="2" type="real">1 3</Array></SimpleSetPredicate>': lambda x: x not in (1, 3),
} | {f'<CompoundPredicate booleanOperator="{op}"><SimplePredicate field="a" operator="lessThan" value="3"/>'
     '<SimplePredicate field="a" operator="greaterThan" value="1"/><SimplePredicate field="a" operator="equal" value="4"/></CompoundPredicate>': f
     for op, f in (("and", lambda x: x < 3 and x > 1 and x == 4), ("or", lambda x: x < 3 or x > 1 or x == 4),
                   ("xor", lambda x: (x < 3) ^ (x > 1) ^ (x == 4)))}


def tree_document(test, strategy="returnNullPrediction"):
    return pmml.Document(
        '<PMML><DataDictionary><DataField name="y"/><DataField name="a"/></DataDictionary><TreeModel functionName="regression" '
        f'noTrueChildStrategy="{strategy}"><MiningSchema><MiningField name="y" usageType="target"/><MiningField name="a"/></MiningSchema>'
        f'<Node score="5"><True/><Node score="9">{test}</Node></Node></TreeModel></PMML>')


@pytest.mark.parametrize("leaves", [64, 0])
@pytest.mark.parametrize("strategy,otherwise", [("returnNullPrediction", None), ("returnLastPrediction", 5.0)])
def test_predicates_in_both_forms(spark, monkeypatch, leaves, strategy, otherwise):
    monkeypatch.setattr(pmml, "MAX_EXPRESSION_LEAVES", leaves)
    values = [0.0, 1.0, 2.0, 3.0, 4.0, None]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    scores = [tree_document(p, strategy).score(["a"]).alias(f"s{i}") for i, p in enumerate(PREDICATES)]
    for row in df.select("a", *scores).collect():
        want = [9.0 if f(row.a or 0.0) else otherwise for f in PREDICATES.values()]
        assert list(row)[1:] == want


@pytest.mark.parametrize("test", ["", '<CompoundPredicate booleanOperator="surrogate"><True/></CompoundPredicate>',
                                  '<SimplePredicate field="a" operator="isMissing"/>'])
def test_other_predicates_are_refused(spark, monkeypatch, test):
    for leaves in (64, 0):
        monkeypatch.setattr(pmml, "MAX_EXPRESSION_LEAVES", leaves)
        with pytest.raises(ValueError):
            tree_document(test).score(["a"])


def test_majority_forest(spark):
    df = wine(spark)
    trees = [df.select("seq", pmml.Document(specs.tree_pmml(4, t, "cls")).score(df.columns).alias("s")).collect() for t in range(3)]
    votes = {}
    for rows in trees:
        for r in rows:
            votes.setdefault(r.seq, []).append(int(r.s))
    got = df.select("seq", pmml.Document(specs.forest_pmml(3, 4, "majorityVote")).score(df.columns).alias("s")).collect()
    for r in got:
        v = votes[r.seq]
        assert r.s == max(specs.CLASSES, key=lambda c: (v.count(c), -specs.CLASSES.index(c)))


def test_unknown_and_broken_models_are_ignored(spark):
    assert scoring.compile_model("R", b"", WINE_FEATURES) is None
    assert scoring.compile_model("PMML", b"<nonsense", WINE_FEATURES) is None
    assert scoring.compile_model("PMML", b"<PMML/>", WINE_FEATURES) is None
    df = scoring.score(wine(spark, 3), "R", b"")
    assert [r.score for r in df.collect()] == [None] * 3


def test_trained_model_separates_classes_and_is_published(spark):
    i = F.col("id")
    cpu = spark.range(400).select(
        i.alias("seq"), F.lit("cpu").alias("data_type"),
        (F.when(i % 40 >= 30, 0.9).otherwise(0.2) + (i % 7) / 100).alias("utilization"),
        F.when(i % 40 >= 30, 1).otherwise(0).alias("class"))
    model = training.fit_width_model(cpu, 3)
    v = training.anomaly_vectors(cpu, 3, model["mean"], model["std"])
    scored = v.select("class", training.anomaly_class("vec", model["weights"], model["intercept"]).alias("r"))
    right = scored.where("class = r").count()
    assert v.count() == 398 and right > 350
    d = training.descriptor(spark, "cpu model", "test", "cpu", model).first()
    assert d.name == "cpu_model" and d.preprocessing.width == 3
    again = v.select(scoring.compile_model(d.model_type, d.data, v.columns).cast("int").alias("r"), "class")
    assert again.where("class = r").count() == right


def test_network_artifact(spark):
    data = json.dumps({"features": ["a", "b", "absent"], "layers": [
        {"weights": [[1, 0], [0, 1], [5, 5]], "bias": [0, 0.5], "activation": "relu"}]}).encode()
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 1.0), (0.5, 0.0)], "a double, b double")
    assert [r.score for r in scoring.score(df, "network", data).collect()] == [0.0, 1.0, 0.0]
