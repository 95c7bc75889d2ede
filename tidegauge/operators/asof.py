"""As-of joins: attach the newest version at or before each record.

`versions` (models, settings) are valid from their order value until the next
version of the same key. A version at the same position as a record applies to it.
Records without a position or a key are kept, with NULL payload; versions without one
are never in force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators import blocks
from tidegauge.operators.blocks import BLOCK
from tidegauge.session import MAX_BROADCAST_BYTES, fits_broadcast

MAX_BROADCAST_VERSIONS = 200_000
MAX_PER_SLOT = 64


def asof_join(data: DataFrame, versions: DataFrame, order: str, version_order: str,
              payload: list[str], keys: list[str] | None = None,
              max_broadcast: int = MAX_BROADCAST_VERSIONS,
              layout: blocks.BlockLayout | None = None) -> DataFrame:
    """`data` with the `payload` columns of its version in force, NULL before the
    first one. Two exact plans: up to `max_broadcast` versions of bounded size (both measured
    first), the data is not shuffled at all; beyond, both sides are cut into blocks."""
    keys = keys or []
    versions = versions.select(*keys, F.col(version_order).cast("bigint").alias("_vo"), *payload).dropna(
        subset=["_vo", *keys])
    n, lo, hi = versions.agg(F.count("_vo"), F.min("_vo"), F.max("_vo")).first()
    if n <= max_broadcast and fits_broadcast(versions, max_broadcast, MAX_BROADCAST_BYTES // 3):
        groups = versions.select(*keys).distinct().count() if keys and n else 1
        joined = _by_interval(data, versions, order, payload, keys, n, groups, lo or 0, hi or 0)
        if joined is not None:
            return joined
    return _by_block(data, versions, order, payload, keys, layout)


def _distinct_versions(versions: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """One version per key and position: the largest payload wins a tie."""
    return (versions.groupBy(*keys, "_vo").agg(F.max(F.struct(*payload)).alias("_p"))
            .select(*keys, "_vo", "_p.*"))


def _by_interval(data, versions, order, payload, keys, n, groups, lo, hi):
    """Broadcast hash join on (key, slot). The time between the first and the last
    version is cut into slots, about one per version of a key; each version is listed
    in the slots it covers (n + groups * slots rows in all, so about 3n), and each record
    compares only with the versions of its slot. At most one of them matches. None
    when versions are so bunched that a slot holds many."""
    slots = max(1, n // max(1, groups))
    width = max(1, -(-(hi - lo + 1) // slots))

    def slot(c):
        raw = F.call_function("div", c - F.lit(lo).cast("bigint"), F.lit(width).cast("bigint"))
        return F.greatest(F.lit(0), F.least(raw, F.lit(slots - 1))).cast("bigint")

    v = _distinct_versions(versions, keys, payload)
    until = F.lead("_vo").over(Window.partitionBy(*keys).orderBy("_vo"))
    v = v.withColumn("_until", until)
    last_slot = F.when(F.col("_until").isNull(), F.lit(slots - 1).cast("bigint")).otherwise(
        slot(F.col("_until") - 1))
    v = v.withColumn("_slot", F.explode(F.sequence(slot(F.col("_vo")), last_slot)))
    if n > MAX_PER_SLOT:
        fullest = v.groupBy(*keys, "_slot").count().agg(F.max("count")).first()[0]
        if fullest > MAX_PER_SLOT:
            return None
    right = F.broadcast(v.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_slot", "_vo", "_until", *payload))
    pos = blocks.position(data, order)
    left = data.withColumn("_pos", pos).withColumn("_s", slot(pos))
    hit = left["_s"] == right["_slot"]
    for k in keys:
        hit = hit & (left[k] == right[f"_k_{k}"])
    hit = hit & (left["_pos"] >= right["_vo"]) & (right["_until"].isNull() | (left["_pos"] < right["_until"]))
    return left.join(right, hit, "left").select(*data.columns, *payload)


def _by_block(data, versions, order, payload, keys, layout):
    """Union of both sides in (key, block) windows; a block inherits the last version
    of its key's earlier blocks through one summary row per block."""
    version = F.struct(*payload)
    d = data.withColumn("_vo", blocks.position(data, order))
    # Both sides count: a burst of versions is cut as well as a burst of records.
    layout = layout or blocks.plan_blocks(d.select("_vo").union(versions.select("_vo")), "_vo")
    d = layout.assign(d, "_vo").withColumn("_version", F.lit(False))
    v = _distinct_versions(versions, keys, payload)
    v = layout.assign(v.withColumn("_p", version).drop(*payload), "_vo").withColumn("_version", F.lit(True))
    both = d.unionByName(v, allowMissingColumns=True)
    w = blocks.in_block(keys, F.col("_vo"), F.col("_version").desc())
    both = both.withColumn("_here", F.last("_p", ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0))).where(~F.col("_version"))
    carried = (d.groupBy(*keys, BLOCK).agg(F.lit(None).cast(v.schema["_p"].dataType).alias("_end"))
               .unionByName(v.groupBy(*keys, BLOCK).agg(F.max_by("_p", "_vo").alias("_end")))
               .groupBy(*keys, BLOCK).agg(F.max("_end").alias("_end")))
    carried = carried.select(*keys, BLOCK, F.last("_end", ignorenulls=True).over(
        blocks.before(keys)).alias("_carried"))
    out = blocks.joined(both, carried, [*keys, BLOCK])
    found = F.when(F.col("_vo").isNotNull(), F.coalesce(F.col("_here"), F.col("_carried")))
    return out.withColumn("_f", found).select(*data.columns, *[F.col(f"_f.{c}").alias(c) for c in payload])


def control_asof(requests: DataFrame, control: DataFrame, order: str, control_order: str,
                 keys: list[str], setting: str, default: int = 100, **kw) -> DataFrame:
    """The setting in force at each request; absent or non-positive means `default`."""
    out = asof_join(requests, control, order, control_order, [setting], keys, **kw)
    return out.withColumn(setting, F.when(F.col(setting) > 0, F.col(setting)).otherwise(
        F.lit(default).cast("bigint")))
