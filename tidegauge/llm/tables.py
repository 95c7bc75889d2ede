"""Small helpers that the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.session import configure, shared_dir
from tidegauge.sinks.files import delete


# Texts go to Python in batches of so many bytes (a longer text is a batch), which bounds the
# memory of a worker whatever the lengths of the documents.
BATCH_BYTES = "8m"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the session settings that the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return configure(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text; a null text counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written below the shared folder and read back, so that later uses neither
    compute it again nor depend on an executor that may be lost."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_dir(spark: SparkSession, name: str) -> str:
    """The folder of that name below the shared one, the same in every run: what one run appends
    there the next one finds."""
    return f"{shared_dir(spark, name).rsplit('/', 1)[0]}/{name}"


def sampled(rows: DataFrame, columns: list[str], n: int, name: str) -> DataFrame:
    """At most `n` rows, those with the smallest hashes of `columns`, stored. Rows above a threshold,
    set by the number of rows, are left out before they are ordered, so that tasks send about `n` rows in
    all."""
    total = rows.count()
    if total <= n:
        return stored(rows, name)
    order, share = F.xxhash64(*columns), 1.2 * n / total + 1e-6
    while True:
        part = rows.where(order <= F.lit(int(share * (1 << 64)) - (1 << 63))) if share < 1 else rows
        chosen = stored(part.orderBy(order, *columns).limit(n), name)
        if share >= 1 or chosen.count() == n:
            return chosen
        share *= 2


def quoted(name: str) -> str:
    """A column name for F.col, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or a longer one if `df` has a column of it (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def carried(df: DataFrame, *more: Column, name: str = "row") -> DataFrame:
    """All columns of `df` in one struct, beside others, so that no names clash; `name.*` gives
    them back."""
    return df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias(name), *more)


def mapped(df: DataFrame, run: Callable, schema: T.StructType | None = None) -> DataFrame:
    """`df.mapInArrow(run, schema)` for columns of any names; the schema of `df` by default. The batches
    that `run` gets and yields have columns by place, with names of their own."""
    schema = df.schema if schema is None else schema

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=[f"c{i}" for i in range(batch.num_columns)])

    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    types = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])
    return plain.mapInArrow(renamed, types).toDF(*schema.names)


class Folders:
    """Tables that one operation needs until its result is stored; `close` deletes them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_dir(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        for path in self.paths:
            delete(self.spark, path)
        self.paths.clear()


def lean(run: Callable) -> Callable:
    """A function for mapInArrow whose Python worker returns its memory when a task ends. Workers
    wait for their next task, and an executor may keep several of them."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            gc.collect()
            with contextlib.suppress(OSError, AttributeError):  # not every C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return task


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and the offsets of its rows."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    if data is None or not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `most` bytes, at least one row each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of many slices, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
