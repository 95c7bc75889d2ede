"""Travel-time regression per destination cell and direction of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import geo, scalar
from tidegauge.operators import blocks
from tidegauge.operators.blocks import BLOCK, BlockLayout

GROUP = ["cell", "bucket"]


def ride_features(rides: DataFrame, strict: bool = False) -> DataFrame:
    """Rides in the city with destination cell, distance, direction bucket, and the
    travel time of finished rides (NULL for START events)."""
    inside = (geo.in_city("start_lon", "start_lat", strict) & geo.in_city("end_lon", "end_lat", strict))
    angle = geo.direction_angle("end_lon", "end_lat", "start_lon", "start_lat")
    return rides.where(inside).select(
        "ride_id", "is_start", "event_time",
        geo.grid_cell("end_lon", "end_lat").alias("cell"),
        geo.direction_bucket(angle).alias("bucket"),
        geo.distance_km("start_lon", "start_lat", "end_lon", "end_lat").alias("dist"),
        F.when(~F.col("is_start"), scalar.travel_minutes("start_t", "end_t")).alias("minutes"))


def _sums():
    x, y = F.col("dist"), F.col("minutes")
    ended = ~F.col("is_start")
    return {"n": F.when(ended, 1).otherwise(0).cast("bigint"),
            "sxy": F.when(ended, x * y).otherwise(0.0),
            "sxx": F.when(ended, x * x).otherwise(0.0)}


def regression_fit(features: DataFrame) -> DataFrame:
    """Least squares through the origin from all finished rides; NULL slope below two."""
    s = _sums()
    fit = features.where(~F.col("is_start")).groupBy(*GROUP).agg(
        F.count("*").alias("n"), F.sum(s["sxy"]).alias("sxy"), F.sum(s["sxx"]).alias("sxx"))
    slope = F.when((F.col("n") >= 2) & (F.col("sxx") > 0), F.col("sxy") / F.col("sxx"))
    return fit.select(*GROUP, "n", slope.alias("slope"))


def end_sums(features: DataFrame) -> DataFrame:
    """n, sxy and sxx of the finished rides per cell and bucket: all a model needs."""
    s = _sums()
    return features.where(~F.col("is_start")).groupBy(*GROUP).agg(*[F.sum(v).alias(k) for k, v in s.items()])


def predict(features: DataFrame, layout: BlockLayout | None = None, initial: DataFrame | None = None) -> DataFrame:
    """Whole predicted minutes for each START event from the END events before it in
    its cell and bucket. Running sums are taken inside time blocks and completed by
    the sums of the group's earlier blocks, and by those of `initial` (see end_sums)."""
    layout = layout or blocks.plan_blocks(features, "event_time")
    rows = layout.assign(features, "event_time")
    sums = _sums()
    w = blocks.in_block(GROUP, "event_time", F.col("is_start").desc(), "ride_id").rowsBetween(
        Window.unboundedPreceding, -1)
    # One window operator for the three sums.
    run = rows.withColumns({k: F.sum(v).over(w) for k, v in sums.items()}).where(F.col("is_start"))
    run = run.fillna(0, list(sums))
    if not layout.single or initial is not None:
        per_block = rows.groupBy(*GROUP, BLOCK).agg(*[F.sum(v).alias(f"_{k}") for k, v in sums.items()])
        earlier = blocks.before(GROUP)
        carried = per_block.select(*GROUP, BLOCK, *[
            F.coalesce(F.sum(f"_{k}").over(earlier), F.lit(0)).alias(f"_{k}") for k in sums])
        if initial is not None:
            # Per-block rows meet the initial sums, not the events.
            carried = blocks.joined(carried, initial.select(*GROUP, *sums), GROUP, "left").select(*GROUP, BLOCK, *[
                (F.col(f"_{k}") + F.coalesce(F.col(k), F.lit(0))).alias(f"_{k}") for k in sums])
        run = blocks.joined(run, carried, [*GROUP, BLOCK])
        for k in sums:
            run = run.withColumn(k, F.col(k) + F.col(f"_{k}"))
    return (run.where((F.col("n") >= 2) & (F.col("sxx") > 0))
            .select("ride_id", (F.col("sxy") / F.col("sxx") * F.col("dist")).cast("int").alias("minutes"))
            .where(F.col("minutes") >= 0))


def path_traffic(rides: DataFrame) -> DataFrame:
    """Rides crossing each grid cell on the straight way (see geo.path_cells), as steps
    rather than arrays so that it stays in generated code; counted before the shuffle."""
    x1, y1 = geo.grid_x("start_lon"), geo.grid_y("start_lat")
    ends = rides.select(x1.alias("x"), y1.alias("y"), (geo.grid_x("end_lon") - x1).alias("dx"),
                        (geo.grid_y("end_lat") - y1).alias("dy"))
    steps = F.greatest(F.abs(F.col("dx")), F.abs(F.col("dy")))
    walk = (ends.withColumn("n", steps).withColumn("span", F.greatest(F.col("n"), F.lit(1)).cast("double"))
            .select("*", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("i")))

    def at(base: str, delta: str):
        return F.col(base) + F.floor(F.col(delta) * F.col("i") / F.col("span") + F.lit(0.5)).cast("int")

    return (walk.select((at("x", "dx") + at("y", "dy") * F.lit(geo.GRID_X)).alias("cell"))
            .groupBy("cell").agg(F.count("*").alias("rides")))
