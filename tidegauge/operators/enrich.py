"""Dimension lookups: weather stations and sky conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import fits_broadcast

# Sky condition codes and their texts.
SKY_CONDITIONS = [
    (0, "None, SKC or CLR"),
    (1, "One okta - 1/10 or less but not zero"),
    (2, "Two oktas - 2/10 - 3/10, or FEW"),
    (3, "Three oktas - 4/10"),
    (4, "Four oktas - 5/10, or SCT"),
    (5, "Five oktas - 6/10"),
    (6, "Six oktas - 7/10 - 8/10"),
    (7, "Seven oktas - 9/10 or more but not 10/10, or BKN"),
    (8, "Eight oktas - 10/10, or OVC"),
    (9, "Sky obscured, or cloud amount cannot be estimated"),
    (10, "Partial obscuration 11: Thin scattered"),
    (12, "Scattered"),
    (13, "Dark scattered"),
    (14, "Thin broken 15: Broken"),
    (16, "Dark broken 17: Thin overcast 18: Overcast"),
    (19, "Dark overcast"),
]
STATION_SCHEMA = ("id string, name string, country_code string, state_code string, "
                  "call_sign string, lat double, long double, elevation double")
MAX_BROADCAST_DIMENSION = 1_000_000


def sky_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SKY_CONDITIONS, "code int, condition string")


def lookup(data: DataFrame, dimension: DataFrame, left_key: str, right_key: str, how: str = "left",
           max_broadcast: int = MAX_BROADCAST_DIMENSION) -> DataFrame:
    """Join a dimension table: `left` enriches, `left_semi` and `left_anti` keep known
    and unknown keys. Broadcast only if the dimension is measured small."""
    if fits_broadcast(dimension, max_broadcast):
        dimension = F.broadcast(dimension)
    return data.join(dimension, data[left_key] == dimension[right_key], how)


def sky_enrich(raw: DataFrame) -> DataFrame:
    sky = sky_lookup(raw.sparkSession)
    return lookup(raw, sky, "sky_condition", "code").drop("code")


def sky_unknown(raw: DataFrame) -> DataFrame:
    return lookup(raw, sky_lookup(raw.sparkSession), "sky_condition", "code", "left_anti")


def station_enrich(raw: DataFrame, stations: DataFrame) -> DataFrame:
    """Weather records with name, country and place of their station (see STATION_SCHEMA)."""
    place = stations.select(F.col("id").alias("_id"), "name", "country_code", "lat", "long", "elevation")
    return lookup(raw, place, "wsid", "_id").drop("_id")
