"""Incremental training extracts, the scaler and the anomaly classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import scalar
from tidegauge.operators import ordered
from tidegauge.operators.blocks import BlockLayout


def training_rows(series: DataFrame, time: str, tie: str, last_time=None,
                  layout: BlockLayout | None = None) -> DataFrame:
    """Rows newer than the high-water mark (all when there is none), numbered in time
    order: Time, CPU, Class. `series` has columns utilization and class."""
    rows = series if last_time is None else series.where(F.col(time) > F.lit(last_time).cast(
        dict(series.dtypes)[time]))
    rows = ordered.ordered_index(rows.select(time, tie, "utilization", "class"),
                                 [F.col(time), F.col(tie)], time, "Time", layout)
    return rows.select("Time", F.col("utilization").alias("CPU"), F.col("class").alias("Class"))


def training_gate(series: DataFrame, time: str, threshold: int = 256, last_time=None) -> DataFrame:
    """One row: how many new rows there are, whether that is enough to train, and the
    mark to store next (unchanged below the threshold)."""
    new = F.lit(True) if last_time is None else F.col(time) > F.lit(last_time).cast(dict(series.dtypes)[time])
    previous = F.lit(last_time).cast(dict(series.dtypes)[time])
    return (series.where(new).agg(F.count("*").alias("n"), F.max(time).alias("_max"))
            .select("n", (F.col("n") >= threshold).alias("complete"),
                    F.when(F.col("n") >= threshold, F.col("_max")).otherwise(previous).alias("mark")))


def fit_scaler(df: DataFrame, column: str, width: int, keys: list[str] | None = None) -> DataFrame:
    """Preprocessing parameters shipped with a model (population deviation)."""
    return df.groupBy(*(keys or [])).agg(
        F.lit(width).alias("width"), F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"))


def anomaly_vectors(cpu: DataFrame, width: int, mean: float, std: float, key: str = "data_type",
                    order: str = "seq", version: str | None = None,
                    layout: BlockLayout | None = None, keep_short: bool = False) -> DataFrame:
    """Sliding vectors of standardised samples. With `version`, a new model starts
    with an empty window (the window belongs to the model)."""
    keys = [key] if version is None else [key, version]
    z = cpu.withColumn("z", scalar.standardize("utilization", mean, std))
    return ordered.sliding_vector(z, keys, order, "z", width, "vec", layout, keep_short)


def fit_classifier(vectors: DataFrame, label: str = "class", max_iter: int = 20):
    """Logistic regression over the vectors with Spark ML; gradients are aggregated on
    the executors. Returns (weights, intercept)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    data = vectors.select(array_to_vector(F.col("vec").cast("array<double>")).alias("features"),
                          F.col(label).cast("double").alias("label"))
    fitted = LogisticRegression(maxIter=max_iter, regParam=0.01).fit(data)
    return [float(w) for w in fitted.coefficients], float(fitted.intercept)


def logit(vec: Column | str, weights: list[float], intercept: float) -> Column:
    v = F.col(vec) if isinstance(vec, str) else vec
    total = F.lit(float(intercept))
    for i, w in enumerate(weights):
        total = total + v[i].cast("double") * F.lit(float(w))
    return total


def anomaly_class(vec: Column | str, weights: list[float], intercept: float) -> Column:
    """Two-way softmax decision as 0 / 1; a tie is 0, a missing vector is NULL."""
    return F.when(logit(vec, weights, intercept) > 0, F.lit(1)).when(
        logit(vec, weights, intercept) <= 0, F.lit(0)).cast("int")


def fit_width_model(cpu: DataFrame, width: int, key: str = "data_type", order: str = "seq") -> dict:
    """Scaler, vectors and classifier in one go: the parameters of a model to publish."""
    p = fit_scaler(cpu, "utilization", width).first()
    vectors = anomaly_vectors(cpu, width, p["mean"], p["std"], key, order)
    weights, intercept = fit_classifier(vectors)
    return {"width": width, "mean": p["mean"], "std": p["std"], "weights": weights, "intercept": intercept}


def descriptor(spark, name: str, description: str, data_type: str, model: dict) -> DataFrame:
    """The published model as one descriptor row with nested preprocessing."""
    import json

    row = (name.replace(" ", "_"), description, data_type, "logistic",
           bytearray(json.dumps({k: model[k] for k in ("weights", "intercept")}, sort_keys=True).encode()), None,
           (model["width"], model["mean"], model["std"], "x", "softmax"))
    return spark.createDataFrame([row], (
        "name string, description string, data_type string, model_type string, data binary, location string, "
        "preprocessing struct<width int, mean double, std double, input string, output string>"))
