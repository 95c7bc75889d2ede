"""Streaming sources. Every reader bounds what one micro-batch may hold: that bounds
the rows of a key which a stateful processor sorts at once. Raise `max_bytes` for
aggregates, joins and the per-batch forms, which have no such limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MAX_BYTES = 256 << 20


def kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
          group: str | None = None, max_offsets: int | None = None, **options) -> DataFrame:
    """Raw key/value rows of a topic. `latest` and lost data tolerated by default, as
    for the live applications; use `earliest` to read results. Needs Spark's Kafka
    package on the classpath."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting).option("failOnDataLoss", "false"))
    if group:
        reader = reader.option("kafka.group.id", group)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.options(**options).load()


def files(spark: SparkSession, path: str, schema, format: str = "parquet", max_files: int | None = None,
          max_bytes: int | None = MAX_BYTES, **options) -> DataFrame:
    """New files of a folder, oldest first. A paced replay is `max_files` together with
    the trigger interval of the query."""
    reader = spark.readStream.format(format).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.options(**options).load(path)


def watched_lines(spark: SparkSession, path: str, pattern: str = "*.csv", max_files: int | None = None) -> DataFrame:
    """Lines of text files as they appear. A file is read once; deliver a changed file
    under a new name."""
    return files(spark, path, "value string", "text", max_files, pathGlobFilter=pattern)
