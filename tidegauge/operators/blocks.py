"""Splitting ordered, keyed data into blocks of bounded size.

Order-dependent operators (running sums, runs, sliding windows, as-of lookups)
are usually written as one window per key, which puts a hot key in one task.
Here the order axis is cut into blocks, the window is partitioned by (key,
block), and what a block needs from earlier blocks of its key is computed from a
small per-block summary: the two-level form of a prefix scan. Blocks hold about
the same number of rows, so no task grows with the share of a key, and a key has
at most `max_blocks` summary rows.

Rows without a position come first: they are in the first block. Keys are compared
null-safely (`joined`), so rows without a key are rows of one key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "_block"
MAX_BLOCKS = 40_000
MIN_BLOCK_ROWS = 1024
BINS_PER_BLOCK = 4


def position(df: DataFrame, order: str) -> Column:
    """The order column as a BIGINT: itself, or microseconds for timestamps."""
    kind = dict(df.dtypes)[order]
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_micros(F.col(order).cast("timestamp"))
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(order).cast("bigint")
    raise TypeError(f"order column {order} is {kind}; need an integer or timestamp")


def _div(a: Column, n: int) -> Column:
    return F.call_function("div", a, F.lit(n).cast("bigint"))


@dataclass(frozen=True)
class BlockLayout:
    """Where blocks begin. `splits` is empty for equal-width blocks; otherwise it
    lists the start of every block after the first, and `bin_width` is the step
    of the lookup table built from it."""

    origin: int
    width: int
    blocks: int
    splits: tuple[int, ...] = ()
    bin_width: int = 0
    bins: int = 0

    @property
    def single(self) -> bool:
        return self.blocks <= 1

    def assign(self, df: DataFrame, order: str) -> DataFrame:
        """`df` with the block number of each row in `_block`."""
        pos = position(df, order)
        if self.single:
            return df.withColumn(BLOCK, F.lit(0).cast("bigint"))
        if not self.splits:
            raw = _div(pos - F.lit(self.origin), self.width)
            return df.withColumn(BLOCK, F.when(raw.isNull(), F.lit(0)).otherwise(F.greatest(
                F.lit(0), F.least(raw, F.lit(self.blocks - 1)))).cast("bigint"))
        # Unequal blocks: find the bin by arithmetic, then the block in the bin. The
        # table has at most bins + blocks rows, both bounded by the layout.
        lookup = F.broadcast(self._table(df.sparkSession))
        slot = F.greatest(F.lit(0), F.least(_div(pos - F.lit(self.origin), self.bin_width),
                                            F.lit(self.bins - 1)))
        keyed = df.withColumn("_pos", pos).withColumn("_bin", slot.cast("bigint"))
        hit = (keyed["_bin"] == lookup["_b"]) & (keyed["_pos"] >= lookup["_from"]) & (
            keyed["_pos"] < lookup["_to"])
        found = keyed.join(lookup, hit, "left").drop("_b", "_from", "_to", "_pos", "_bin")
        return found.withColumn(BLOCK, F.coalesce(BLOCK, F.lit(0).cast("bigint")))

    def _table(self, spark):
        lo_bound, hi_bound = -(2 ** 62), 2 ** 62
        starts = [lo_bound, *self.splits]
        ends = [*self.splits, hi_bound]
        rows = []
        for block, (start, end) in enumerate(zip(starts, ends)):
            first = max(0, min(self.bins - 1, (max(start, self.origin) - self.origin) // self.bin_width))
            last = max(0, min(self.bins - 1, (min(end - 1, self.origin + self.bins * self.bin_width - 1)
                                              - self.origin) // self.bin_width))
            rows += [(b, start, end, block) for b in range(first, last + 1)]
        return spark.createDataFrame(rows, f"_b bigint, _from bigint, _to bigint, {BLOCK} bigint")


ONE_BLOCK = BlockLayout(0, 1, 1)


def plan_blocks(df: DataFrame, order: str, max_blocks: int = MAX_BLOCKS,
                min_rows: int = MIN_BLOCK_ROWS) -> BlockLayout:
    """Choose about sqrt(rows) blocks, at most `max_blocks`, from two aggregates
    over the order column alone: its range, then a histogram of at most
    4 * max_blocks bins. Bins that are still too full (bursts) are refined, so the
    bound holds for uneven data too; only rows of one equal position stay together.
    """
    pos = df.select(position(df, order).alias("p")).where("p is not null")
    lo, hi, rows = pos.agg(F.min("p"), F.max("p"), F.count("p")).first()
    if not rows:
        return ONE_BLOCK
    blocks = max(1, min(math.isqrt(rows), rows // max(1, min_rows), max_blocks))
    if blocks == 1:
        return ONE_BLOCK
    # The bin width is a power of two, so that bins can be halved exactly.
    span = hi - lo + 1
    bin_width = 1 << max(0, (-(-span // (blocks * BINS_PER_BLOCK)) - 1).bit_length())
    bins = -(-span // bin_width)
    width = bin_width * BINS_PER_BLOCK
    blocks = -(-span // width)
    limit = -(-rows // blocks)
    counts = _histogram(pos, lo, bin_width)
    by_block: dict[int, int] = {}
    for b, n in counts.items():
        by_block[b // BINS_PER_BLOCK] = by_block.get(b // BINS_PER_BLOCK, 0) + n
    if max(by_block.values()) <= 2 * limit:
        return BlockLayout(lo, width, blocks)
    splits, filled = [], 0
    for start, n in _refine(pos, lo, bin_width, counts, limit):
        if filled and filled + n > limit:
            splits.append(start)
            filled = 0
        filled += n
    return BlockLayout(lo, width, len(splits) + 1, tuple(splits), bin_width, bins)


def _histogram(pos: DataFrame, origin: int, width: int) -> dict[int, int]:
    h = pos.groupBy(_div(F.col("p") - F.lit(origin), width).alias("b")).count()
    return {r[0]: r[1] for r in h.collect()}


def _refine(pos: DataFrame, origin: int, width: int, counts: dict[int, int],
            limit: int) -> list[tuple[int, int]]:
    """(start, rows) of pieces in order, cutting bins with more than `limit` rows into
    up to 64 until none is left or they hold one position only. Full bins number at
    most rows / limit in every round, which bounds the tables built here."""
    pieces: list[tuple[int, int]] = []
    while True:
        full = [b for b, n in counts.items() if n > limit and width > 1]
        pieces += [(origin + b * width, n) for b, n in counts.items() if n <= limit or width == 1]
        if not full:
            return sorted(pieces)
        chosen = F.broadcast(pos.sparkSession.createDataFrame([(b,) for b in full], "b bigint"))
        pos = (pos.withColumn("b", _div(F.col("p") - F.lit(origin), width))
               .join(chosen, "b", "left_semi").select("p"))
        width = max(1, width // 64)
        counts = _histogram(pos, origin, width)


def joined(rows: DataFrame, summary: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """`rows` with the other columns of `summary`, joined on `keys` where NULL equals NULL."""
    other = summary.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in summary.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(other, same, how).drop(*[f"_k_{k}" for k in keys])


def before(keys: list[str]):
    """Window over all earlier blocks of a key, for per-block summaries only."""
    return Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def up_to(keys: list[str]):
    """Window over a key's blocks up to and including the current one."""
    return Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, 0)


def in_block(keys: list[str], *order: Column | str):
    """Ordered window inside one (key, block)."""
    return Window.partitionBy(*keys, BLOCK).orderBy(*order)
