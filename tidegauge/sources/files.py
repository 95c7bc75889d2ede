"""File sources: text lines from csv, csv.gz and csv.zip, CSV dimensions, artifacts."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.enrich import STATION_SCHEMA
from tidegauge.sources import archives, storage

ZIP_BATCH_LINES = 10_000


def _zip_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for entry in (e for e in z.infolist() if not e.is_dir()):
                    with z.open(entry) as f:
                        rows: list[str] = []
                        for line in io.TextIOWrapper(f, encoding="utf-8"):
                            rows.append(line.rstrip("\r\n"))
                            if len(rows) == ZIP_BATCH_LINES:
                                yield pd.DataFrame({"value": rows, "file": path})
                                rows = []
                        if rows:
                            yield pd.DataFrame({"value": rows, "file": path})


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All lines of *.csv, *.csv.gz and every entry of *.csv.zip below the paths, as
    (value, file); other files are ignored. Plain files are split by Spark, a gzip
    file is one task, and archives are read entry by entry (see archives). Where only Spark
    can open a store, an archive is one task and at most 2 GB."""
    paths = [paths] if isinstance(paths, str) else paths

    def text(pattern: str) -> DataFrame:
        return (spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(paths)
                .select("value", F.col("_metadata.file_path").alias("file")))

    zips = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv.zip")
            .option("recursiveFileLookup", "true").load(paths))
    plain = text("*.csv").unionByName(text("*.csv.gz"))
    if all(storage.supported(p) for p in paths):
        return plain.unionByName(archives.read_archives(zips.select("path")))
    return plain.unionByName(zips.select("path", "content").mapInPandas(_zip_lines, "value string, file string"))


def write_zip(df: DataFrame, path: str, entry: str = "part.csv") -> None:
    """Rows as comma-separated lines, one csv.zip per partition, in a folder of a store that Arrow can
    write. A retried task replaces its own file."""
    columns = df.columns

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, inner = storage.locate(path)
        store.create_dir(inner, recursive=True)
        name = f"{inner}/part-{context.partitionId():05d}"
        part = f"{name}.{context.taskAttemptId()}.tmp"
        n = 0
        with store.open_output_stream(part) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, z.open(
                entry, "w", force_zip64=True) as f:
            for pdf in batches:
                f.write(pdf[columns].to_csv(header=False, index=False).encode())
                n += len(pdf)
        store.move(part, f"{name}.csv.zip")
        yield pd.DataFrame({"n": [n]})

    df.mapInPandas(save, "n bigint").agg(F.sum("n")).collect()


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATION_SCHEMA).csv(path)


def read_artifacts(spark: SparkSession, path: str, pattern: str = "*.pmml", streaming: bool = False) -> DataFrame:
    """Model files as (name, model_type, data); as a stream, one file per trigger, so
    that the trigger interval paces the publication."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("binaryFile").option("pathGlobFilter", pattern)
    if streaming:
        reader = reader.option("maxFilesPerTrigger", 1).schema(
            "path string, modificationTime timestamp, length bigint, content binary")
    name = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return reader.load(path).select(name.alias("name"), F.lit("PMML").alias("model_type"), F.col("content").alias("data"))
