"""The scalar functions by name in SQL text.

They are SQL functions, which Spark inlines into the query, so they are optimised and
compiled like built-ins.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidegauge.functions import geo

FUNCTIONS = {
    "grid_cell(lon FLOAT, lat FLOAT) RETURNS INT":
        f"CAST(floor(({-geo.LON_WEST}D - abs(CAST(lon AS DOUBLE))) / {geo.DELTA_LON}D) AS INT) "
        f"+ CAST(floor(({geo.LAT_NORTH}D - CAST(lat AS DOUBLE)) / {geo.DELTA_LAT}D) AS INT) * {geo.GRID_X}",
    "in_city(lon FLOAT, lat FLOAT) RETURNS BOOLEAN":
        f"CAST(lon AS DOUBLE) BETWEEN {geo.LON_WEST}D AND {geo.LON_EAST}D "
        f"OR CAST(lat AS DOUBLE) BETWEEN {geo.LAT_SOUTH}D AND {geo.LAT_NORTH}D",
    "in_city_strict(lon FLOAT, lat FLOAT) RETURNS BOOLEAN":
        f"CAST(lon AS DOUBLE) BETWEEN {geo.LON_WEST}D AND {geo.LON_EAST}D "
        f"AND CAST(lat AS DOUBLE) BETWEEN {geo.LAT_SOUTH}D AND {geo.LAT_NORTH}D",
    "cell_center_lon(cell INT) RETURNS FLOAT":
        f"-CAST({-geo.LON_WEST}D - cell % {geo.GRID_X} * {geo.DELTA_LON}D - {geo.DELTA_LON / 2!r}D AS FLOAT)",
    "cell_center_lat(cell INT) RETURNS FLOAT":
        f"CAST({geo.LAT_NORTH}D - CAST((cell - cell % {geo.GRID_X}) / {geo.GRID_X} AS INT) * {geo.DELTA_LAT}D "
        f"- {geo.DELTA_LAT / 2!r}D AS FLOAT)",
    "direction_angle(lon1 FLOAT, lat1 FLOAT, lon2 FLOAT, lat2 FLOAT) RETURNS INT":
        "CAST(degrees(atan2(CAST(lat2 - lat1 AS DOUBLE), CAST(lon2 - lon1 AS DOUBLE) * cos(CAST(lat1 AS DOUBLE)))) AS INT) + 179",
    "direction_bucket(angle INT) RETURNS INT": f"CAST(angle / {360 // geo.DIRECTION_BUCKETS} AS INT)",
    "distance_km(lon1 FLOAT, lat1 FLOAT, lon2 FLOAT, lat2 FLOAT) RETURNS DOUBLE":
        f"{geo.DEGREE_KM}D * sqrt(CAST((lat1 - lat2) * (lat1 - lat2) AS DOUBLE) "
        "+ pow(CAST(lon1 - lon2 AS DOUBLE) * cos(CAST(lat2 AS DOUBLE)), 2))",
    "class_tag(class INT) RETURNS STRING": "CASE WHEN class = 0 THEN 'normal' ELSE 'anomaly' END",
    "standardize(value DOUBLE, mean DOUBLE, std DOUBLE) RETURNS FLOAT": "CAST((value - mean) / std AS FLOAT)",
}


def register(spark: SparkSession) -> None:
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
