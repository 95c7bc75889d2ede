"""Placement of keys on shards by a permutation-filled lookup table.

Each shard has a permutation of the slots of a prime-sized table, given by an offset and a step
from its name. Shards take turns, and in its turn a shard claims the first slot of its
permutation that is free. Shards own equally many slots (one more or less), and when a shard
leaves, most keys of the others stay. The table has `size` rows, whatever the number of keys,
so it is broadcast and a placement is one lookup.

Nulls: a null key counts as the empty text. Repeated keys get equal places. An empty table gives
no rows. Columns named slot or shard in the input are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.tables import quoted

MAX_SIZE = 10_000_019


def name_hash(name: str) -> int:
    """The first 15 hexadecimal digits of the MD5 sum of a text, as a number."""
    return int(hashlib.md5(name.encode()).hexdigest()[:15], 16)


def key_hash(key: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], size: int) -> list[int]:
    """The number of the shard that owns each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names are distinct, at least one")
    if not _is_prime(size) or not len(shards) <= size <= MAX_SIZE:
        raise ValueError("the table size is a prime, not less than the number of shards")
    at = [name_hash(f"offset {s}") % size for s in shards]
    step = [name_hash(f"step {s}") % (size - 1) + 1 if size > 2 else 1 for s in shards]
    owner, free = [-1] * size, size
    while True:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % size
            owner[at[i]] = i
            free -= 1
            if not free:
                return owner


def assign(df: DataFrame, key: str, shards: list[str], size: int = 65_537) -> DataFrame:
    """`df` with slot and shard (its number in `shards`)."""
    spark: SparkSession = df.sparkSession
    owners = spark.createDataFrame(list(enumerate(lookup_table(shards, size))), "slot long, shard int")
    rows = df.drop("slot", "shard").withColumn("slot", F.pmod(key_hash(F.col(key)), F.lit(size).cast("long")))
    return rows.join(F.broadcast(owners), "slot").select(*[F.col(quoted(c)) for c in rows.columns], "shard")


def write_shards(df: DataFrame, path: str, key: str, shards: list[str], size: int = 65_537) -> None:
    """One folder per shard. Nothing is shuffled; each task writes its rows of every shard."""
    assign(df, key, shards, size).write.partitionBy("shard").parquet(path)
