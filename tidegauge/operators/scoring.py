"""Model registry, scoring, serving rows and serving statistics."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import pmml
from tidegauge.operators import dispatch, training

_LOG = logging.getLogger(__name__)

Factory = Callable[[bytes, list[str]], Column]


def _logistic(data: bytes, columns: list[str]) -> Column:
    p = json.loads(bytes(data))
    return training.anomaly_class("vec", p["weights"], p["intercept"]).cast("double")


def _vector(kind: str) -> Factory:
    """A score by a numpy model, as a vectorised function over Arrow batches."""
    def build(data: bytes, columns: list[str]) -> Column:
        model = dispatch.VECTOR_FACTORIES[kind](data)
        run, width = model.run, len(model.fields)
        present = [(i, f) for i, f in enumerate(model.fields) if f in columns]
        places = [i for i, _ in present]

        @F.pandas_udf("double")
        def scored(*series: pd.Series) -> pd.Series:
            x = np.zeros((len(series[0]), width))
            for i, s in zip(places, series):
                x[:, i] = s.fillna(0.0).to_numpy()
            return pd.Series(run(x))

        # A model that needs none of the columns scores rows of zeros.
        return scored(*[F.col(f).cast("double") for _, f in present] or [F.lit(0.0)])

    return build


# Model type of a descriptor to the function that compiles its bytes.
FACTORIES: dict[str, Factory] = {
    "PMML": lambda data, columns: pmml.Document(bytes(data)).score(columns),
    "logistic": _logistic,
    "network": _vector("network"),
}


def compile_model(model_type: str, data: bytes, columns: list[str],
                  factories: dict[str, Factory] | None = None) -> Column | None:
    """The score expression, or None for an unknown type or a broken artifact."""
    factory = (factories or FACTORIES).get(model_type)
    if factory is None:
        return None
    try:
        return factory(data, columns)
    except Exception:  # noqa: BLE001 - a broken model is ignored, the stream goes on
        _LOG.warning("model of type %s cannot be used", model_type, exc_info=True)
        return None


def score(df: DataFrame, model_type: str, data: bytes, name: str = "score") -> DataFrame:
    expr = compile_model(model_type, data, df.columns)
    return df.withColumn(name, expr if expr is not None else F.lit(None).cast("double"))


def _vectorised(model_type: str, data: bytes) -> bool:
    if model_type == "PMML":
        try:
            return pmml.Document(bytes(data)).vectorised
        except Exception:  # noqa: BLE001 - broken models are reported where they are compiled
            return False
    return model_type == "network"


def score_dispatch(df: DataFrame, models: list[tuple[str, str, bytes]], by: str = "model",
                   name: str = "score", factories: dict[str, Factory] | None = None) -> DataFrame:
    """Score each row with the model named in column `by`. `models` is the registry
    (name, type, bytes); rows of ignored or unknown models get NULL. Models that are expressions are
    branches of one; the others run over Arrow batches divided by model. So a row is evaluated by its
    own model only. Own `factories` give expressions."""
    out: Column | None = None
    vectors = {}
    for model, kind, data in models:
        if factories is None and _vectorised(kind, data):
            vectors[model] = (kind, bytes(data))
            continue
        expr = compile_model(kind, data, df.columns, factories)
        if expr is not None:
            hit = F.col(by) == model
            out = F.when(hit, expr) if out is None else out.when(hit, expr)
    scored = df.withColumn(name, out if out is not None else F.lit(None).cast("double"))
    return dispatch.score_rows(scored, vectors, by, name) if vectors else scored


def serving_rows(scored: DataFrame, keep: list[str], model: str = "model", source: str = "class",
                 result: str = "result") -> DataFrame:
    """Serving records: was there a model, which one, expected class and result. The time
    per record is known where records are served as they come (see streaming.online)."""
    return scored.select(*keep, F.col(model).isNotNull().alias("processed"), F.col(model).alias("model"),
                         F.col(source).alias("source"), F.col(result).cast("int").alias("result"))


def complete_only(rows: DataFrame, result: str = "result") -> DataFrame:
    return rows.where(F.col(result).isNotNull())


def confusion(rows: DataFrame) -> DataFrame:
    return (rows.where(F.col("result").isNotNull()).groupBy("source", F.col("result").alias("served"))
            .agg(F.count("*").alias("n")))


def serving_stats(rows: DataFrame, keys: list[str], duration: str, since: str) -> DataFrame:
    """Usage, total, shortest and longest duration per model version, and its start."""
    d = F.col(duration)
    return rows.groupBy(*keys).agg(F.count("*").alias("usage"), F.sum(d).alias("duration"),
                                   F.min(d).alias("min_duration"), F.max(d).alias("max_duration"),
                                   F.min(since).alias("since"))


def model_catalog(models: DataFrame, key: str = "data_type", model: str = "model",
                  only: str | None = None) -> DataFrame:
    """Distinct models per data type, by exact key."""
    out = models.select(key, model).distinct()
    return out if only is None else out.where(F.col(key) == only)
