"""Model serving: as-of joins, scoring, ensembles, statistics and training."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidegauge.fixtures import duck, view
from tidegauge.functions import parse, scalar
from tidegauge.operators import asof, blocks, ensemble, scoring, timeseries, training
from tidegauge.plans import model_specs as specs
from tidegauge.plans.common import r, rounded
from tidegauge.session import shared_dir
from tidegauge.sources import files

QUERIES = {}
SQL = {}


def _cpu(s, d):
    return view(s, d, "cpu")


# As-of joins --------------------------------------------------------------------

QUERIES["asof_global"] = lambda s, d: asof.asof_join(
    _cpu(s, d).select("seq", "data_type"), view(s, d, "models"), "seq", "seq", ["model"])
SQL["asof_global"] = duck(
    "select c.seq, c.data_type, m.model from cpu c asof left join models m on c.seq >= m.seq", "cpu", "models")

_KEYED = "select c.seq, c.data_type, m.model from cpu c asof left join {0} m on c.data_type = m.data_type and c.seq >= m.seq"
QUERIES["asof_keyed"] = lambda s, d: asof.asof_join(
    _cpu(s, d).select("seq", "data_type"), view(s, d, "models"), "seq", "seq", ["model"], ["data_type"])
SQL["asof_keyed"] = duck(_KEYED.format("models"), "cpu", "models")

# Versions that grow with the data: by broadcast while they are few, and in blocks.
for _name, _limit in (("asof_published", asof.MAX_BROADCAST_VERSIONS), ("asof_published_blocks", 0)):
    QUERIES[_name] = lambda s, d, limit=_limit: asof.asof_join(
        _cpu(s, d).select("seq", "data_type"), view(s, d, "published"), "seq", "seq", ["model"], ["data_type"],
        max_broadcast=limit)
    SQL[_name] = duck(_KEYED.format("published"), "cpu", "published")
QUERIES["asof_global_blocks"] = lambda s, d: asof.asof_join(
    _cpu(s, d).select("seq", "data_type"), view(s, d, "published").drop("data_type"), "seq", "seq", ["model"],
    max_broadcast=0)
SQL["asof_global_blocks"] = duck(
    "select c.seq, c.data_type, m.model from cpu c asof left join published m on c.seq >= m.seq", "cpu", "published")

# Records without a key or a position keep their row, under either plan.
_GAPS = "select seq as id, nullif(seq, seq // 97 * 97) as seq, case when seq % 11 <> 0 then data_type end as data_type from cpu"
for _name, _limit in (("asof_nulls", asof.MAX_BROADCAST_VERSIONS), ("asof_nulls_blocks", 0)):
    QUERIES[_name] = lambda s, d, limit=_limit: asof.asof_join(
        s.sql("select seq as id, nullif(seq, seq div 97 * 97) as seq, case when seq % 11 <> 0 then data_type end as data_type "
              "from {cpu}", cpu=_cpu(s, d)), view(s, d, "published"), "seq", "seq", ["model"], ["data_type"],
        max_broadcast=limit)
    SQL[_name] = duck(f"select c.id, c.seq, c.data_type, m.model from ({_GAPS}) c asof left join published m "
                      "on c.data_type = m.data_type and c.seq >= m.seq", "cpu", "published")


def _timeouts(s, d):
    return asof.control_asof(view(s, d, "requests"), view(s, d, "controls"), "request_id", "seq", ["data_type"], "tmout")


_TIMEOUTS = ("tm as (select q.*, case when c.tmout > 0 then c.tmout else 100 end as tmout from requests q asof left join "
             "controls c on q.data_type = c.data_type and q.request_id >= c.seq)")
QUERIES["control_asof"] = lambda s, d: _timeouts(s, d).select("request_id", "data_type", "tmout")
SQL["control_asof"] = duck(f"with {_TIMEOUTS} select request_id, data_type, cast(tmout as bigint) as tmout from tm",
                           "requests", "controls")

# Small functions ----------------------------------------------------------------

QUERIES["default_key"] = lambda s, d: _cpu(s, d).select("seq", scalar.default_key("data_type").alias("data_type"))
SQL["default_key"] = duck("select seq, case when data_type = '' then 'cpu' else data_type end as data_type from cpu", "cpu")

QUERIES["class_tag"] = lambda s, d: _cpu(s, d).select("seq", scalar.class_to_tag("class").alias("tag")).withColumn(
    "class", scalar.tag_to_class(F.upper("tag")))
SQL["class_tag"] = duck("select seq, case class when 0 then 'normal' else 'anomaly' end as tag, class from cpu", "cpu")

_W, _MEAN, _STD = specs.PREPROCESSING
QUERIES["standardize"] = lambda s, d: rounded(
    _cpu(s, d).select("seq", scalar.standardize("utilization", _MEAN, _STD).alias("z")))
_Z = f"cast((utilization - {_MEAN}::double) / {_STD}::double as float)"
SQL["standardize"] = duck(f"select seq, {r(_Z, 'z')} from cpu", "cpu")

QUERIES["argmax"] = lambda s, d: view(s, d, "wine").select(
    "seq", scalar.argmax(F.array("fixed_acidity", "residual_sugar", "alcohol")).alias("k"))
SQL["argmax"] = duck("select seq, cast(list_position(a, list_max(a)) - 1 as int) as k from "
                     "(select seq, [fixed_acidity, residual_sugar, alcohol] as a from wine) t", "wine")

QUERIES["model_desc"] = lambda s, d: view(s, d, "published").select("seq", scalar.model_text(
    F.concat(F.lit("cpu model "), "model"), F.lit("as of signup"), "data_type", F.lit("logistic")).alias("text"))
SQL["model_desc"] = duck("select seq, concat_ws(' | ', replace(concat('cpu model ', model), ' ', '_'), 'as of signup', "
                         "data_type, 'logistic') as text from published", "published")

QUERIES["run_props"] = lambda s, d: parse.parse_properties(view(s, d, "run_lines")).select(
    "run", "suffix", F.size(F.map_keys("props")).alias("n"), F.col("props")["view"].alias("view_value"))
SQL["run_props"] = duck("""
with t as (select run, trim(value) as v from run_lines),
kv as (select run, trim(split_part(v, '=', 1)) as k, max(trim(substr(v, strpos(v, '=') + 1))) as v from t
  where not starts_with(v, '#') and strpos(v, '=') > 0 group by all)
select run, string_agg(v, '' order by k) as suffix, cast(count(*) as int) as n, max(v) filter (where k = 'view') as view_value
from kv group by run""", "run_lines")

# Wine -----------------------------------------------------------------------------

QUERIES["wine_parse"] = lambda s, d: rounded(
    parse.keep_valid(parse.parse_wine(view(s, d, "wine_lines"))).drop("value", "data_type"))
SQL["wine_parse"] = duck("select seq, " + ", ".join(r(c, c) for c in parse.WINE_FEATURES) + " from wine where seq % 83 <> 0", "wine")


def _scored(kind, text):
    return lambda s, d: rounded(scoring.score(view(s, d, "wine"), kind, text().encode()).select("seq", "score"))


_DEPTH, _TREES, _FOREST_DEPTH = 5, 10, 6
for _name, _text, _sql in (
    ("score_linear", specs.linear_pmml, specs.linear_sql(specs.LINEAR)),
    ("score_glm_gauss", lambda: specs.general_pmml(specs.GAUSSIAN, "normal"), specs.linear_sql(specs.GAUSSIAN)),
    ("score_glm_gamma", lambda: specs.general_pmml(specs.GAMMA, "gamma"), specs.linear_sql(specs.GAMMA)),
    ("score_tree_reg", lambda: specs.tree_pmml(_DEPTH, 1, "reg"), specs.tree_score_sql(_DEPTH, 1, "reg")),
    ("score_tree_cls", lambda: specs.tree_pmml(_DEPTH, 2, "cls"), specs.tree_score_sql(_DEPTH, 2, "cls")),
):
    QUERIES[_name] = _scored("PMML", _text)
    SQL[_name] = duck(f"select seq, {r(_sql, 'score')} from wine", "wine")
# Compound and set predicates, as an expression and (score_tree_arrays) in arrays.
QUERIES["score_tree_predicates"] = _scored("PMML", specs.predicate_pmml)
SQL["score_tree_predicates"] = duck(f"select seq, {r(specs.PREDICATE_SQL, 'score')} from wine", "wine")
QUERIES["score_tree_arrays"] = _scored("PMML", lambda: specs.predicate_pmml(copies=30))
SQL["score_tree_arrays"] = SQL["score_tree_predicates"]
QUERIES["score_forest"] = _scored("PMML", lambda: specs.forest_pmml(_TREES, _FOREST_DEPTH))
SQL["score_forest"] = duck(specs.forest_sql(_TREES, _FOREST_DEPTH, "wine", "seq"), "wine")
QUERIES["score_mlp"] = _scored("PMML", specs.network_pmml)
SQL["score_mlp"] = duck(specs.network_sql("wine", "seq"), "wine")


def _network_json() -> str:
    layers = [{"weights": [[specs.weight(n, i, j) for j in range(specs.NETWORK_LAYERS[n + 1])]
                           for i in range(specs.NETWORK_LAYERS[n])],
               "bias": [specs.bias(n, j) for j in range(specs.NETWORK_LAYERS[n + 1])],
               "activation": "logistic" if n < len(specs.NETWORK_LAYERS) - 2 else "identity"}
              for n in range(len(specs.NETWORK_LAYERS) - 1)]
    return json.dumps({"features": parse.WINE_FEATURES, "layers": layers})


# Inputs are 32-bit floats here, and the result is the position of the class.
QUERIES["score_network"] = _scored("network", _network_json)
_SINGLE = ("(select seq, " + ", ".join(f"cast(cast({c} as float) as double) as {c}" for c in parse.WINE_FEATURES)
           + " from wine) w")
SQL["score_network"] = duck(specs.network_sql(_SINGLE, "seq", range(len(specs.CLASSES))), "wine")


def _dispatch(s, d):
    wine = view(s, d, "wine").withColumn(
        "model", F.when(F.col("line") <= 2, "linear").when(F.col("line") == 3, "tree")
        .when(F.col("line") == 4, "broken").otherwise("unknown"))
    registry = [("linear", "PMML", specs.linear_pmml().encode()), ("tree", "PMML", specs.tree_pmml(_DEPTH, 1, "reg").encode()),
                ("broken", "PMML", b"<PMML"), ("unknown", "R_MODEL", b"")]
    return rounded(scoring.score_dispatch(wine, registry).select("seq", "model", "score"))


QUERIES["score_dispatch"] = _dispatch
SQL["score_dispatch"] = duck(
    "select seq, case when line <= 2 then 'linear' when line = 3 then 'tree' when line = 4 then 'broken' else 'unknown' end as model, "
    + r(f"case when line <= 2 then {specs.linear_sql(specs.LINEAR)} when line = 3 then {specs.tree_score_sql(_DEPTH, 1, 'reg')} end",
        "score") + " from wine", "wine")

# Serving of CPU samples ---------------------------------------------------------

_REGISTRY = [(m, "logistic", json.dumps({"weights": w, "intercept": b}).encode()) for m, (w, b) in specs.LOGISTIC.items()]


def _serve(s, d, keep=("seq", "data_type")):
    cpu = _cpu(s, d).withColumn("data_type", scalar.default_key("data_type"))
    with_model = asof.asof_join(cpu, view(s, d, "models"), "seq", "seq", ["model"], ["data_type"])
    # The layout comes from the samples alone, not from the joined rows.
    layout = blocks.plan_blocks(cpu, "seq")
    vectors = training.anomaly_vectors(with_model, _W, _MEAN, _STD, version="model", layout=layout, keep_short=True)
    return scoring.serving_rows(scoring.score_dispatch(vectors, _REGISTRY, name="result"), list(keep))


def _logit_sql():
    arms = " ".join(
        f"when '{m}' then {b!r}::double" + "".join(f" + ({x!r}::double) * cast(vec[{i + 1}] as double)" for i, x in enumerate(w))
        for m, (w, b) in specs.LOGISTIC.items())
    return f"case model {arms} end"


_SERVED = f"""
k as (select seq, ts, class, utilization, case when data_type = '' then 'cpu' else data_type end as data_type from cpu),
j as (select k.*, m.model from k asof left join models m on k.data_type = m.data_type and k.seq >= m.seq),
v as (select *, list({_Z}) over (partition by data_type, model order by seq rows between {_W - 1} preceding and current row) as vec from j),
sv as (select seq, ts, data_type, model is not null as processed, model, class as source,
  case when len(vec) = {_W} then cast({_logit_sql()} > 0 as int) end as result from v)"""
QUERIES["serving_rows"] = _serve
SQL["serving_rows"] = duck(f"with {_SERVED} select * exclude (ts) from sv", "cpu", "models")
QUERIES["serving_complete"] = lambda s, d: scoring.complete_only(_serve(s, d))
SQL["serving_complete"] = duck(f"with {_SERVED} select * exclude (ts) from sv where result is not null", "cpu", "models")
QUERIES["confusion"] = lambda s, d: scoring.confusion(_serve(s, d))
SQL["confusion"] = duck(f"with {_SERVED} select source, result as served, cast(count(*) as bigint) as n from sv "
                        "where result is not null group by all", "cpu", "models")


def _slide(s, d):
    v = training.anomaly_vectors(_cpu(s, d), _W, _MEAN, _STD)
    return rounded(v.select("seq", "data_type", *[F.col("vec")[i].alias(f"z{i}") for i in range(_W)]))


QUERIES["slide_vec"] = _slide
SQL["slide_vec"] = duck(
    f"with v as (select seq, data_type, list({_Z}) over (partition by data_type order by seq rows between {_W - 1} preceding "
    "and current row) as vec from cpu) select seq, data_type, " + ", ".join(r(f"vec[{i + 1}]", f"z{i}") for i in range(_W))
    + f" from v where len(vec) = {_W}", "cpu")

QUERIES["fit_scaler"] = lambda s, d: rounded(training.fit_scaler(_cpu(s, d), "utilization", _W, ["data_type"]))
SQL["fit_scaler"] = duck(f"select data_type, {_W} as width, {r('avg(utilization)', 'mean')}, "
                         f"{r('stddev_pop(utilization)', 'std')} from cpu group by data_type", "cpu")


def _anomaly_score(s, d):
    cpu = _cpu(s, d)
    m = training.fit_width_model(cpu, _W)
    v = training.anomaly_vectors(cpu, _W, m["mean"], m["std"])
    return v.select("seq", "data_type", training.anomaly_class("vec", m["weights"], m["intercept"]).alias("result"))


QUERIES["anomaly_score"] = _anomaly_score

# The same scoring with weights that are given.
def _anomaly_fixed(s, d):
    weights, intercept = specs.LOGISTIC["a"]
    v = training.anomaly_vectors(_cpu(s, d), _W, _MEAN, _STD)
    return v.select("seq", "data_type", training.anomaly_class("vec", weights, intercept).alias("result"))


_FIXED = f"{specs.LOGISTIC['a'][1]!r}::double" + "".join(
    f" + ({x!r}::double) * cast(vec[{i + 1}] as double)" for i, x in enumerate(specs.LOGISTIC["a"][0]))
QUERIES["anomaly_fixed"] = _anomaly_fixed
SQL["anomaly_fixed"] = duck(
    f"with v as (select seq, data_type, list({_Z}) over (partition by data_type order by seq rows between {_W - 1} preceding "
    f"and current row) as vec from cpu) select seq, data_type, cast({_FIXED} > 0 as int) as result from v where len(vec) = {_W}",
    "cpu")

# Ensembles ----------------------------------------------------------------------

QUERIES["fanout"] = lambda s, d: ensemble.fanout(_cpu(s, d).select("seq", "data_type"), view(s, d, "models"))
SQL["fanout"] = duck("select c.seq, c.data_type, m.model from cpu c left join models m on c.data_type = m.data_type",
                     "cpu", "models")

_VOTE = ("coalesce(bool_or(processed), false) as processed, max(case when processed then source end) as source, "
         "case when avg(case when processed then coalesce(result, 0) end) < 0.5 then 0 "
         "when avg(case when processed then coalesce(result, 0) end) >= 0.5 then 1 end as result, "
         "cast(count(*) filter (where processed) as bigint) as votes")
QUERIES["vote"] = lambda s, d: ensemble.vote(view(s, d, "responses"))
SQL["vote"] = duck(f"select request_id, {_VOTE} from responses group by request_id", "responses")


def in_time_sql(timeout, source):
    return (f"vt as (select q.request_id, q.data_type, q.req_ts, {timeout} as lim, r.resp_ts, r.processed, r.result, r.source from {source} q "
            f"left join responses r on q.request_id = r.request_id and r.resp_ts >= q.req_ts and r.resp_ts <= q.req_ts + {timeout}), "
            f"dec as (select request_id, data_type, {_VOTE}, cast(case when count(resp_ts) >= 3 then max(resp_ts) - any_value(req_ts) "
            "else any_value(lim) end as bigint) as duration from vt group by request_id, data_type)")


QUERIES["vote_timeout"] = lambda s, d: ensemble.vote_timeout(
    view(s, d, "requests"), view(s, d, "responses"), 100, 3, keep=["data_type"])
SQL["vote_timeout"] = duck(f"with {in_time_sql('100', 'requests')} select * from dec", "requests", "responses")


def _voted(s, d):
    return ensemble.vote_timeout(_timeouts(s, d), view(s, d, "responses"), F.col("tmout"), 3, keep=["data_type"])


QUERIES["vote_control"] = _voted
SQL["vote_control"] = duck(f"with {_TIMEOUTS}, {in_time_sql('q.tmout', 'tm')} select * from dec", "requests", "responses", "controls")
QUERIES["ensemble_stats"] = lambda s, d: ensemble.ensemble_stats(_voted(s, d))
SQL["ensemble_stats"] = duck(
    f"with {_TIMEOUTS}, {in_time_sql('q.tmout', 'tm')} select data_type, cast(count(*) as bigint) as usage, "
    "cast(sum(duration) as bigint) as duration, min(duration) as min_duration, max(duration) as max_duration "
    "from dec where processed group by data_type", "requests", "responses", "controls")

QUERIES["serving_stats"] = lambda s, d: scoring.serving_stats(view(s, d, "responses"), ["model"], "latency", "resp_ts")
SQL["serving_stats"] = duck(
    "select model, cast(count(*) as bigint) as usage, cast(sum(latency) as bigint) as duration, min(latency) as min_duration, "
    "max(latency) as max_duration, min(resp_ts) as since from responses group by model", "responses")
QUERIES["model_catalog"] = lambda s, d: scoring.model_catalog(view(s, d, "published"), only="cpu1")
SQL["model_catalog"] = duck("select distinct data_type, model from published where data_type = 'cpu1'", "published")

# Training extract, retention, panels ----------------------------------------------

_MARK = "2024-01-10 00:00:00"
QUERIES["train_incremental"] = lambda s, d: rounded(training.training_rows(_cpu(s, d), "ts", "seq", _MARK))
SQL["train_incremental"] = duck(
    f"select cast(row_number() over (order by ts, seq) as bigint) as \"Time\", {r('utilization', 'CPU')}, class as \"Class\" "
    f"from cpu where ts > timestamp '{_MARK}'", "cpu")


def _gate(s, d):
    g = training.training_gate(_cpu(s, d), "ts", 256, _MARK)
    return g.withColumn("mark", F.date_format("mark", parse.TIME_PATTERN))


QUERIES["train_gate"] = _gate
SQL["train_gate"] = duck(
    "select cast(count(*) as bigint) as n, count(*) >= 256 as complete, strftime(case when count(*) >= 256 then max(ts) "
    f"else timestamp '{_MARK}' end, '%Y-%m-%d %H:%M:%S') as mark from cpu where ts > timestamp '{_MARK}'", "cpu")

QUERIES["retention"] = lambda s, d: timeseries.retain(_cpu(s, d), "ts").select("seq", "data_type")
SQL["retention"] = duck("select seq, data_type from cpu where ts >= (select max(ts) from cpu) - interval 1 day", "cpu")


QUERIES["panel_cpu"] = lambda s, d: rounded(timeseries.panel(
    _cpu(s, d), "ts", ["data_type"], ["utilization"], window="6 HOUR").drop("ts"))
SQL["panel_cpu"] = duck(f"select data_type, {r('utilization', 'utilization')} from cpu "
                        "where ts >= (select max(ts) from cpu) - interval 6 hour", "cpu")
QUERIES["panel_serving"] = lambda s, d: timeseries.panel(
    _serve(s, d, ("seq", "ts", "data_type")), "ts", ["data_type", "model"], ["seq", "source", "result"], window="6 HOUR").drop("ts")
SQL["panel_serving"] = duck(
    f"with {_SERVED} select data_type, model, seq, source, result from sv "
    "where ts >= (select max(ts) from sv) - interval 6 hour", "cpu", "models")


def _panel_wine(s, d):
    scored = scoring.score(view(s, d, "wine"), "PMML", specs.linear_pmml().encode())
    return rounded(timeseries.panel(scored.withColumn("engine", F.lit("PMML")), "ts", ["engine"], ["seq", "score"],
                                    window="30 DAY").drop("ts"))


QUERIES["panel_wine"] = _panel_wine
SQL["panel_wine"] = duck(f"select 'PMML' as engine, seq, {r(specs.linear_sql(specs.LINEAR), 'score')} from wine "
                         "where ts >= (select max(ts) from wine) - interval 30 day", "wine")

# Files ----------------------------------------------------------------------------


def _src_files(s, d):
    """The weather records as plain, gzip and zip text files, read back as one bag."""
    path = shared_dir(s, "src-files")
    names = [c for c, _ in parse.WEATHER_CSV]
    raw = view(s, d, "weather_raw").select("seq", *names)
    raw.where(F.col("sky_condition") < 7).write.csv(f"{path}/plain")
    raw.where(F.col("sky_condition").between(7, 13)).write.csv(f"{path}/gz", compression="gzip")
    files.write_zip(raw.where(F.col("sky_condition") > 13), f"{path}/zip")
    lines = files.read_lines(s, [f"{path}/plain", f"{path}/gz", f"{path}/zip"])
    head = F.substring_index("value", ",", 1).cast("bigint")
    rest = lines.select(head.alias("seq"), F.expr("substr(value, instr(value, ',') + 1)").alias("value"))
    return rounded(parse.keep_valid(parse.parse_weather(rest)).drop("value", "sky_condition_text"))


QUERIES["src_files"] = _src_files
SQL["src_files"] = duck("select seq, " + ", ".join(r(c, c) if k == "double" else c for c, k in parse.WEATHER_CSV)
                        + " from weather_raw", "weather_raw")
