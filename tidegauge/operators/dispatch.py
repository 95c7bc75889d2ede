"""Scoring rows with the model that each of them names, where models are data.

Models come as bytes with a type. Workers compile them when they meet them and keep the last
`CACHED` compiled ones by digest, from task to task. Every batch is divided by model, so a row is
evaluated by its own model only. Models that fit a measured broadcast are sent to all executors and the
rows stay where they are; otherwise rows and models meet by digest in a shuffle, where a model with
many rows has copies for parts of them, and a task holds one model at a time.

Rows that name no model, an unknown one or one that cannot be compiled get NULL.
"""

from __future__ import annotations

import hashlib
import json
import logging
import sys
import types
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions import pmml
from tidegauge.session import MAX_BROADCAST_BYTES, fits_broadcast

_LOG = logging.getLogger(__name__)
CACHED = 64
MAX_MODELS = 10_000
# Rows that share one copy of a model in the shuffled form.
PART_ROWS = 200_000


@dataclass
class VectorModel:
    """Columns and a function from rows of them, missing values as 0, to scores."""

    fields: list[str]
    run: Callable[[np.ndarray], np.ndarray]


def _network(data: bytes) -> VectorModel:
    """A dense network given as JSON: feature columns, layers of weights (inputs x
    outputs) and biases, activation per layer. The class is the position of the
    largest output."""
    p = json.loads(bytes(data))
    layers = [(np.array(x["weights"], dtype=float), np.array(x["bias"], dtype=float), x.get("activation", "relu"))
              for x in p["layers"]]
    act = {"relu": lambda z: np.maximum(z, 0), "logistic": lambda z: 1 / (1 + np.exp(-z)),
           "tanh": np.tanh, "identity": lambda z: z}

    def run(x: np.ndarray) -> np.ndarray:
        h = x.astype("float32").astype("float64")
        for w, b, a in layers:
            h = act[a](h @ w + b)
        return np.argmax(h, axis=1).astype(float)

    return VectorModel(list(p["features"]), run)


def _logistic(data: bytes) -> VectorModel:
    """Two classes over a vector: 1 where the weighted sum is positive."""
    p = json.loads(bytes(data))
    weights, intercept = np.array(p["weights"], dtype=float), float(p["intercept"])
    return VectorModel(["vec"], lambda x: (x.astype("float32").astype("float64") @ weights + intercept > 0).astype(float))


# Model type of a descriptor to the function that compiles its bytes on a worker.
VECTOR_FACTORIES: dict[str, Callable[[bytes], VectorModel]] = {
    "PMML": lambda data: VectorModel(*pmml.Document(bytes(data)).runner()),
    "network": _network,
    "logistic": _logistic,
}


def compile_vector(model_type: str, data: bytes, factories: dict | None = None) -> VectorModel | None:
    """The compiled model, or None for an unknown type or a broken artifact."""
    factory = (VECTOR_FACTORIES if factories is None else factories).get(model_type)
    if factory is None or data is None:
        return None
    try:
        return factory(bytes(data))
    except Exception:  # noqa: BLE001 - a broken model is ignored, the stream goes on
        _LOG.warning("model of type %s cannot be used", model_type, exc_info=True)
        return None


def worker_cache(name: str) -> OrderedDict:
    """A cache of this Python process, kept from task to task: functions come to workers by value with
    fresh globals, so it lives in a module of its own that is found by name."""
    module = sys.modules.setdefault("_tidegauge_worker", types.ModuleType("_tidegauge_worker"))
    return module.__dict__.setdefault(name, OrderedDict())


def compiled(model_type: str, data: bytes, factories: dict | None = None) -> VectorModel | None:
    """As `compile_vector`, from the cache where the same bytes were compiled before."""
    if factories is not None:
        return compile_vector(model_type, data, factories)
    cache, key = worker_cache("models"), (model_type, hashlib.sha256(data or b"").digest())
    if key not in cache:
        cache[key] = compile_vector(model_type, data)
    cache.move_to_end(key)
    while len(cache) > CACHED:
        cache.popitem(last=False)
    return cache[key]


def _matrix(columns: dict[str, pa.Array], fields: list[str], n: int) -> np.ndarray:
    if fields == ["vec"] and "vec" in columns:
        return np.array([v if v is not None else [] for v in columns["vec"].to_pylist()], dtype=float).reshape(n, -1)
    x = np.zeros((n, len(fields)))
    for i, f in enumerate(fields):
        if f in columns:
            x[:, i] = np.nan_to_num(columns[f].cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False),
                                    nan=0.0, posinf=np.inf, neginf=-np.inf)
    return x


def _fill(columns: dict[str, pa.Array], names: pa.Array, score: pa.Array, find: Callable[[str], VectorModel | None]) -> pa.Array:
    """`score` with the values of the rows whose model `find` gives."""
    key = names.dictionary_encode()
    code = key.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    out = score.cast(pa.float64()).to_numpy(zero_copy_only=False).copy()
    for c, name in enumerate(key.dictionary.to_pylist()):
        model = find(name)
        if model is None:
            continue
        rows = np.flatnonzero(code == c)
        own = {f: pc.take(columns[f], pa.array(rows)) for f in model.fields if f in columns}
        out[rows] = model.run(_matrix(own, model.fields, len(rows)))
    return pa.array(out, pa.float64(), from_pandas=True)


def score_rows(df: DataFrame, models: dict[str, tuple[str, bytes]], by: str, name: str = "score",
               factories: dict | None = None) -> DataFrame:
    """`df` with its column `name` (double) filled where `by` names one of `models` (name to type and
    bytes, which are broadcast)."""
    spread, columns = df.sparkSession.sparkContext.broadcast(models), df.columns
    at, place = columns.index(by), columns.index(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def find(model: str) -> VectorModel | None:
            return compiled(*spread.value[model], factories) if model in spread.value else None

        for batch in batches:
            out = list(batch.columns)
            out[place] = _fill(dict(zip(columns, out)), out[at], out[place], find)
            yield pa.RecordBatch.from_arrays(out, names=columns)

    return df.mapInArrow(run, df.schema)


def score_by_digest(rows: DataFrame, models: DataFrame, digest: str = "digest", name: str = "score",
                    max_bytes: int = MAX_BROADCAST_BYTES, part_rows: int = PART_ROWS) -> DataFrame:
    """`rows` with `name`, the score by the model whose digest they carry. models: digest,
    model_type, data."""
    blank = rows.withColumn(name, F.lit(None).cast("double"))
    models = models.select(F.col("digest").alias(digest), "model_type", "data").dropDuplicates([digest])
    if fits_broadcast(models, MAX_MODELS, max_bytes):
        return score_rows(blank, {r[0]: (r[1], bytes(r[2])) for r in models.collect()}, digest, name)
    return _score_shuffled(blank, models, digest, name, part_rows)


def _score_shuffled(rows: DataFrame, models: DataFrame, digest: str, name: str, part_rows: int) -> DataFrame:
    parts = rows.groupBy(digest).agg(F.expr(f"(count(*) - 1) div {part_rows} + 1").alias("_parts"))
    parts = parts.join(models.select(digest), digest)
    row = F.struct(*[F.col(c) for c in rows.columns]).alias("_row")
    # Rows without a model stay where they are.
    known = F.broadcast(parts) if fits_broadcast(parts, MAX_MODELS) else parts
    asking = rows.join(known, digest).select(
        F.col(digest).alias("_digest"), F.pmod(F.xxhash64(*rows.columns), "_parts").alias("_part"), F.lit(1).alias("_kind"),
        row, F.lit(None).cast("string").alias("_type"), F.lit(None).cast("binary").alias("_data"))
    copies = models.join(parts, digest).select(
        F.col(digest).alias("_digest"), F.explode(F.expr("sequence(0L, _parts - 1)")).alias("_part"), F.lit(0).alias("_kind"),
        F.lit(None).cast(asking.schema["_row"].dataType).alias("_row"), F.col("model_type").alias("_type"),
        F.col("data").alias("_data"))
    met = copies.unionByName(asking).repartition("_digest", "_part").sortWithinPartitions("_digest", "_part", "_kind")
    schema: T.StructType = rows.schema
    place, names = rows.columns.index(name), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, model = None, None
        for batch in batches:
            keys = batch.column(0).to_pylist()
            kinds = batch.column(2).to_numpy()
            edges = [0, *(i for i in range(1, len(keys)) if kinds[i] == 0 or kinds[i - 1] == 0), len(keys)]
            for i, j in zip(edges, edges[1:]):
                if kinds[i] == 0:
                    if keys[i] != current:
                        current = keys[i]
                        model = compiled(batch.column(4)[i].as_py(), batch.column(5)[i].as_py())
                    continue
                part = batch.column(3).slice(i, j - i)
                out = [part.field(c) for c in range(len(names))]
                if model is not None:
                    out[place] = _fill(dict(zip(names, out)), batch.column(0).slice(i, j - i), out[place],
                                       lambda _, own=model: own)
                yield pa.RecordBatch.from_arrays(out, names=names)

    scored = met.select("_digest", "_part", "_kind", "_row", "_type", "_data").mapInArrow(run, schema)
    left = rows.join(known.select(digest), digest, "left_anti")
    return scored.unionByName(left)
