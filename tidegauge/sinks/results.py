"""Result topics and training files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidegauge.operators import training
from tidegauge.sinks import files


def prediction_lines(predictions: DataFrame) -> DataFrame:
    """`ride id,minutes` as a `value` column, the form of the result topic."""
    return predictions.select(F.concat_ws(",", F.col("ride_id").cast("string"), F.col("minutes").cast("string")).alias("value"))


def to_topic(values: DataFrame, checkpoint: str, servers: str | None = None, topic: str | None = None,
             path: str | None = None) -> DataStreamWriter:
    """Writer of a `value` column to a Kafka topic, or to text files at `path`."""
    writer = values.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if path is not None:
        return writer.format("text").option("path", path)
    return writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)


def to_console(df: DataFrame, checkpoint: str, discard: bool = False) -> DataStreamWriter:
    return df.writeStream.option("checkpointLocation", checkpoint).format("noop" if discard else "console")


MARK = "mark"


def read_mark(spark: SparkSession, root: str) -> str | None:
    """The stored high-water mark; None before the first complete extract."""
    if not files.exists(spark, f"{root}/{MARK}/_SUCCESS"):
        return None
    return spark.read.schema("mark string").json(f"{root}/{MARK}").first()[0]


def write_training_set(series: DataFrame, root: str, time: str, tie: str, threshold: int = 256) -> bool:
    """Extract the rows after the mark to `root/data` as CSV with header. Only with
    enough rows is the completion marker written and, last, the mark advanced; the data
    is replaced either way. Repeating it after a failure gives the same files."""
    spark = series.sparkSession
    mark = read_mark(spark, root)
    gate = training.training_gate(series, time, threshold, mark).withColumn("mark", F.col("mark").cast("string")).first()
    if gate["n"]:
        # Rows that arrive while this runs stay for the next extract.
        series = series.where(F.col(time) <= series.select(F.max(time)).scalar()) if not gate["complete"] else series.where(
            F.col(time) <= F.lit(gate["mark"]).cast(dict(series.dtypes)[time]))
    training.training_rows(series, time, tie, mark).sortWithinPartitions("Time").write.mode("overwrite").option(
        "header", "true").csv(f"{root}/data")
    if not gate["complete"]:
        files.delete(spark, f"{root}/complete")
        return False
    row = spark.createDataFrame([(gate["n"],)], "rows bigint")
    row.coalesce(1).write.mode("overwrite").json(f"{root}/complete")
    spark.createDataFrame([(gate["mark"],)], "mark string").coalesce(1).write.mode("overwrite").json(f"{root}/{MARK}")
    return True
