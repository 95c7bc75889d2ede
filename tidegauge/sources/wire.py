"""Protobuf records on topics.

With Spark's protobuf package on the classpath its own functions are used, so column
pruning reaches into the message. Otherwise records are decoded and encoded in Arrow
batches with the protobuf Python package. A record that cannot be decoded gives NULL.
"""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRING, _INT, _LONG, _DOUBLE, _BYTES = "string", "int", "bigint", "double", "binary"

# Wire names, types and field numbers.
MESSAGES: dict[str, list[tuple[str, str, int]]] = {
    "WeatherRecord": [
        ("wsid", _STRING, 1), ("year", _INT, 2), ("month", _INT, 3), ("day", _INT, 4), ("hour", _INT, 5),
        ("temperature", _DOUBLE, 7), ("dewpoint", _DOUBLE, 8), ("pressure", _DOUBLE, 9),
        ("windDirection", _INT, 10), ("windSpeed", _DOUBLE, 11), ("skyCondition", _INT, 12),
        ("skyConditionText", _STRING, 13), ("oneHourPrecip", _DOUBLE, 14), ("sixHourPrecip", _DOUBLE, 15),
    ],
    "CPUData": [("utilization", _DOUBLE, 1), ("class", _INT, 2), ("dataType", _STRING, 3)],
    "SpeculativeDescriptor": [("datatype", _STRING, 1), ("tmout", _LONG, 2)],
    "WineRecord": [
        ("fixed_acidity", _DOUBLE, 1), ("volatile_acidity", _DOUBLE, 2), ("citric_acid", _DOUBLE, 3),
        ("residual_sugar", _DOUBLE, 4), ("chlorides", _DOUBLE, 5), ("free_sulfur_dioxide", _DOUBLE, 6),
        ("total_sulfur_dioxide", _DOUBLE, 7), ("density", _DOUBLE, 8), ("pH", _DOUBLE, 9),
        ("sulphates", _DOUBLE, 10), ("alcohol", _DOUBLE, 11), ("dataType", _STRING, 12),
    ],
}
_DEFAULTS = {_STRING: "", _INT: 0, _LONG: 0, _DOUBLE: 0.0, _BYTES: b""}


def schema(message: str) -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(k)) for n, k, _ in MESSAGES[message]])


def descriptor_set(message: str) -> bytes:
    """The message as a serialised FileDescriptorSet."""
    from google.protobuf import descriptor_pb2 as pb

    kinds = {_STRING: pb.FieldDescriptorProto.TYPE_STRING, _INT: pb.FieldDescriptorProto.TYPE_INT32,
             _LONG: pb.FieldDescriptorProto.TYPE_INT64, _DOUBLE: pb.FieldDescriptorProto.TYPE_DOUBLE,
             _BYTES: pb.FieldDescriptorProto.TYPE_BYTES}
    file = pb.FileDescriptorProto(name=f"{message}.proto", package="tidegauge", syntax="proto3")
    m = file.message_type.add(name=message)
    for name, kind, number in MESSAGES[message]:
        m.field.add(name=name, number=number, type=kinds[kind], label=pb.FieldDescriptorProto.LABEL_OPTIONAL)
    return pb.FileDescriptorSet(file=[file]).SerializeToString()


def _message_class(message: str, descriptors: bytes):
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    pool = descriptor_pool.DescriptorPool()
    for f in descriptor_pb2.FileDescriptorSet.FromString(descriptors).file:
        pool.Add(f)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"tidegauge.{message}"))


def _native(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(
            "org.apache.spark.sql.protobuf.ProtobufDataToCatalyst")
        return True
    except Exception:  # noqa: BLE001 - the class is absent
        return False


def from_wire(df: DataFrame, message: str, column: str = "value") -> Column:
    """The decoded message of a binary column as a struct."""
    descriptors = descriptor_set(message)
    if _native(df.sparkSession):
        from pyspark.sql.protobuf.functions import from_protobuf

        return from_protobuf(F.col(column), message, binaryDescriptorSet=descriptors, options={"mode": "PERMISSIVE"})
    names = [n for n, _, _ in MESSAGES[message]]

    @F.pandas_udf(schema(message))
    def decode(data: pd.Series) -> pd.DataFrame:
        cls = _message_class(message, descriptors)
        rows = []
        for b in data:
            try:
                m = cls.FromString(b)
                rows.append([getattr(m, n) for n in names])
            except Exception:  # noqa: BLE001 - undecodable records become NULL
                rows.append([None] * len(names))
        return pd.DataFrame(rows, columns=names, dtype=object)

    return decode(F.col(column))


def to_wire(df: DataFrame, message: str, columns: dict[str, str] | None = None) -> Column:
    """Encode columns (wire name to column, same names by default) as a message."""
    descriptors = descriptor_set(message)
    columns = columns or {}
    source = {n: columns.get(n, n) for n, _, _ in MESSAGES[message]}
    packed = F.struct(*[F.coalesce(F.col(source[n]).cast(k), F.lit(_DEFAULTS[k])).alias(n)
                        for n, k, _ in MESSAGES[message]])
    if _native(df.sparkSession):
        from pyspark.sql.protobuf.functions import to_protobuf

        return to_protobuf(packed, message, binaryDescriptorSet=descriptors)

    @F.pandas_udf("binary")
    def encode(rows: pd.DataFrame) -> pd.Series:
        cls = _message_class(message, descriptors)
        return pd.Series([cls(**r).SerializeToString() for r in rows.to_dict("records")], dtype=object)

    return encode(packed)


# Wire names of the weather record whose column names differ.
WEATHER_WIRE = {"windDirection": "wind_direction", "windSpeed": "wind_speed", "skyCondition": "sky_condition",
                "skyConditionText": "sky_condition_text", "oneHourPrecip": "one_hour_precip",
                "sixHourPrecip": "six_hour_precip"}


def decode_weather(df: DataFrame, column: str = "value") -> DataFrame:
    """Binary records to the 14 weather columns, undecodable ones dropped; other columns
    are kept."""
    m = df.withColumn("_m", from_wire(df, "WeatherRecord", column)).where(F.col("_m.wsid").isNotNull())
    return m.select(*[c for c in df.columns if c != column],
                    *[F.col(f"_m.{n}").alias(WEATHER_WIRE.get(n, n)) for n, _, _ in MESSAGES["WeatherRecord"]])
