"""Row numbers, sliding vectors, latest rows and ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators import blocks
from tidegauge.operators.blocks import BLOCK, BlockLayout


def ordered_index(df: DataFrame, order: list[Column], position: str, name: str = "i",
                  layout: BlockLayout | None = None) -> DataFrame:
    """Number rows 1..n in `order`, whose first column must be `position`. Rows are
    numbered inside blocks and shifted by the count of all earlier blocks."""
    layout = layout or blocks.plan_blocks(df, position)
    rows = layout.assign(df, position)
    number = F.row_number().over(blocks.in_block([], *order)).cast("bigint")
    rows = rows.withColumn(name, number)
    if layout.single:
        return rows.drop(BLOCK)
    counts = rows.groupBy(BLOCK).agg(F.count("*").alias("_n"))
    shift = counts.select(BLOCK, F.coalesce(F.sum("_n").over(blocks.before([])), F.lit(0)).alias("_shift"))
    # At most MAX_BLOCKS rows by construction of the layout.
    out = rows.join(F.broadcast(shift), BLOCK)
    return out.withColumn(name, F.col(name) + F.col("_shift")).drop(BLOCK, "_shift")


def sliding_vector(df: DataFrame, keys: list[str], order: str, value: str, width: int,
                   name: str = "vec", layout: BlockLayout | None = None,
                   keep_short: bool = False) -> DataFrame:
    """The last `width` values of each key, oldest first. Rows with fewer values before
    them are left out, or get NULL with `keep_short`. `order` must be unique within a key.

    Each block is preceded by the key's last width-1 rows of earlier blocks. Those
    come from the last width-1 rows of every (key, block), which the per-group limit
    cuts before the shuffle."""
    layout = layout or blocks.plan_blocks(df, order)
    rows = layout.assign(df, order).withColumn("_lead_in", F.lit(False))
    if width > 1 and not layout.single:
        rows = rows.unionByName(_lead_in(rows, keys, order, value, width - 1), allowMissingColumns=True)
    frame = blocks.in_block(keys, order).rowsBetween(-(width - 1), 0)
    rows = rows.withColumn(name, F.collect_list(value).over(frame))
    rows = rows.where(~F.col("_lead_in")).drop(BLOCK, "_lead_in")
    full = F.size(name) == width
    return rows.withColumn(name, F.when(full, F.col(name))) if keep_short else rows.where(full)


def _lead_in(rows: DataFrame, keys: list[str], order: str, value: str, n: int) -> DataFrame:
    rank = F.row_number().over(blocks.in_block(keys, F.col(order).desc()))
    tails = (rows.select(*keys, BLOCK, order, value).withColumn("_rank", rank)
             .where(F.col("_rank") <= n))
    # The last n rows of a key up to the end of each block, handed to its next block.
    w = Window.partitionBy(*keys).orderBy(order)
    item = F.struct(F.col(order).alias("o"), F.col(value).alias("v"))
    at_end = (tails.withColumn("_tail", F.collect_list(item).over(w.rowsBetween(-(n - 1), 0)))
              .where(F.col("_rank") == 1).select(*keys, BLOCK, "_tail"))
    following = F.lead(BLOCK).over(Window.partitionBy(*keys).orderBy(BLOCK))
    return (at_end.withColumn(BLOCK, following).where(F.col(BLOCK).isNotNull())
            .select(*keys, BLOCK, F.explode("_tail").alias("t"))
            .select(*keys, BLOCK, F.col("t.o").alias(order), F.col("t.v").alias(value),
                    F.lit(True).alias("_lead_in")))


def latest_per_key(df: DataFrame, pk: list[str], order: list[Column]) -> DataFrame:
    """The newest row of each primary key; `order` is newest first. Spark limits the
    groups before the shuffle, so a hot key sends one row per task."""
    rn = F.row_number().over(Window.partitionBy(*pk).orderBy(*order))
    return df.withColumn("_rn", rn).where(F.col("_rn") == 1).drop("_rn")


def latest_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rn") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def stored_order(df: DataFrame, keys: list[str], clustering: list[str], partitions: int | None = None) -> DataFrame:
    """Physical order of a clustered table: range-partitioned by key and clustering
    columns (newest first), so a hot key spans several files."""
    order = [*[F.col(k) for k in keys], *[F.col(c).desc() for c in clustering]]
    out = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return out.sortWithinPartitions(*order)


def ride_order() -> list[Column]:
    """Taxi events by time, START before END, then by ride."""
    return [F.col("event_time").asc(), F.col("is_start").desc(), F.col("ride_id").asc()]
