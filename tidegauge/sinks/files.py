"""Small file-system helpers over Spark's own Hadoop client (any supported store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty if it does not exist."""
    p, fs = _path(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.delete(p, True)
