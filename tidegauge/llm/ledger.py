"""Results kept by content: each distinct text is worked on once per version.

A store is a folder of Parquet batches below any path Spark can write, partitioned by version.
Work on a table means: digest every text, keep the digests that the store lacks for this
version, work on one text of each of them, append the results, and join them to all rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import stored, text_of


def digest(text_column: str) -> Column:
    """SHA-256 of the whole text in UTF-8; a null text has the digest of the empty one."""
    return F.sha2(text_of(text_column).cast("binary"), 256)


def read_store(spark, path: str, version: str, schema: str) -> DataFrame:
    """Stored results of one version; empty where nothing is stored yet."""
    folder = f"{path}/version={version}"
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def resolve(rows: DataFrame, store: str, version: str, schema: str,
            work: Callable[[DataFrame], DataFrame], text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows with `_digest` instead of the text, results of this version by `_digest`).

    `work` gets a table (_digest, text) of texts whose digest is not stored and returns rows of
    `schema`, one per digest. They are appended as one new batch. A batch that fails is not
    seen by later readers, and a repeated one only repeats equal rows, which are read once.
    """
    spark = rows.sparkSession
    texts = rows.select(text_of(text_column).alias("text")).select(digest("text").alias("_digest"), "text")
    known = read_store(spark, store, version, schema).select("_digest")
    # One text of each digest; aggregated before the shuffle, so a task sends one of a hot group. The
    # join with what is stored uses the same partitioning.
    distinct = texts.groupBy("_digest").agg(F.first("text").alias("text"))
    missing = distinct.join(known, "_digest", "left_anti")
    work(missing).write.parquet(f"{store}/version={version}/batch={os.urandom(8).hex()}")
    # Stored by itself, so that the join with the rows has no aggregate in its stage and Spark can
    # divide the rows of a hot digest.
    found = stored(read_store(spark, store, version, schema).dropDuplicates(["_digest"]), "found")
    keyed = rows.withColumn("_digest", digest(text_column)).drop(text_column)
    return keyed, found
