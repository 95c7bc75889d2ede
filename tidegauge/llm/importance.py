"""Importance resampling towards a target distribution.

Features are the runs of 1 to `runs` consecutive words, hashed into buckets. The counts of all
documents and of all target texts give each bucket a gain, the logarithm of how much likelier it is
in the target; the gains are one array of fixed length that scores every document. The weight of a
document is the mean gain of its features, and its score is the weight plus Gumbel noise drawn from
the id, so the highest scores are a sample without replacement in proportion to exp(weight).

The cutoff of the highest scores is found without a sort of all: every partition gives the median of
its remaining keys, the median of these weighted by the sizes of the partitions splits the remaining
keys such that at least a quarter lies on either side, and the side that cannot hold the cutoff is
discarded, until the split is the cutoff key itself. Then only the winners are sorted, in blocks.

Keys are (score falling, id rising, features rising). Nulls: a null text has no words; a null id
draws its noise as the empty text and comes after all ids of its score. Rows with equal id, features
and score are interchangeable and take neighbouring ranks. A document without features has weight 0.
Empty tables are allowed on both sides. Ids are integers. Other columns are not read, so their names
may clash with any of ours. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.tables import lean, steps, stored, text_of, utf8
from tidegauge.operators import blocks

BUCKETS = 10_000
SEED = "2024"
# Bytes of text that are worked on at a time, and values that an explode makes of a row.
STEP_BYTES = 1 << 21
CHUNK = 10_000
# The remaining keys are written anew when they are fewer than this part of the last table.
SHRINK = 16

# A-Z to a-z; digits, small letters and everything beyond ASCII are inside words.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_NO_ID = (1 << 63) - 1


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of some texts, the word number of each occurrence, and the offsets of the
    texts in the occurrences."""
    data = _LOWER[data]
    inside = _INSIDE[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    edges = np.flatnonzero(edge)
    runs = inside[edges[:-1]] if len(data) else np.zeros(0, bool)
    if not runs.any():
        return [], np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1,
                                   [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)])
    words = pieces.filter(pa.array(runs)).dictionary_encode()
    return (words.dictionary.to_pylist(), words.indices.to_numpy().astype(np.int64),
            np.searchsorted(edges[:-1][runs], offsets))


def features(data: np.ndarray, offsets: np.ndarray, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every feature, the text it is in, and the number of words of each text."""
    words, number, at = words_of(data, offsets)
    n_words = np.diff(at)
    row = np.repeat(np.arange(len(n_words)), n_words)
    found, rows = [], []
    for n in range(1, runs + 1):
        if n > len(number):
            break
        inside = row[:len(row) - n + 1] == row[n - 1:]
        if n == 1:
            bucket = np.array([crc32(w) % buckets for w in words], np.int64)[number]
        else:
            tuples = np.lib.stride_tricks.sliding_window_view(number, n)[inside]
            distinct, own = np.unique(tuples, axis=0, return_inverse=True)
            bucket = np.array([crc32(b" ".join([words[i] for i in t])) % buckets for t in distinct.tolist()],
                              np.int64)[own.ravel()]
        found.append(bucket)
        rows.append(row[:len(row) - n + 1][inside])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *found]), np.concatenate([empty, *rows]), n_words


def bucket_counts(texts: DataFrame, text_column: str = "text", runs: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts are in each bucket; a task sends one row per bucket."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in steps(offsets, STEP_BYTES):
                own = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], runs, buckets)[0]
                total += np.bincount(own, minlength=buckets)
        here = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(total[here])], names=["bucket", "n"])

    counted = texts.select(text_of(text_column).alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket at most
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in the target and the source."""
    size = float(len(source))
    s, t = source.astype(float), target.astype(float)
    ratio = (t + 1) * (float(source.sum()) + size) / ((s + 1) * (float(target.sum()) + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, the same for the same id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weigh(docs: DataFrame, gain: np.ndarray, id_column: str = "doc_id", text_column: str = "text", runs: int = 1,
          seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    spread = docs.sparkSession.sparkContext.broadcast(gain)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = spread.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            parts = []
            for i, j in steps(offsets, STEP_BYTES):
                own, row, n_words = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], runs, len(gain))
                n = np.bincount(row, minlength=j - i)
                total = np.zeros(j - i, np.int64)
                np.add.at(total, row, gain[own])
                parts.append((n_words, n, np.where(n > 0, total // np.maximum(n, 1), 0)))
            columns = [np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*parts)] or [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
    weighed = rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _keys(batches: list[pa.RecordBatch]) -> np.ndarray:
    """Rows (-score, no id, id, n_features) in falling order of preference."""
    columns = [np.concatenate([np.zeros(0, np.int64), *(b.column(c).to_numpy() for b in batches)]) for c in range(4)]
    order = np.lexsort(columns[::-1])
    return np.stack(columns, axis=1)[order]


def _below(keys: np.ndarray, pivot: tuple) -> tuple[int, int]:
    """How many of the sorted keys are before the pivot, and how many up to it."""
    low, high = 0, len(keys)
    for c, value in enumerate(pivot):
        part = keys[low:high, c]
        low, high = low + int(np.searchsorted(part, value)), low + int(np.searchsorted(part, value, side="right"))
    return low, high


def _survey(keys: DataFrame, low: tuple | None, high: tuple | None, pivot: tuple | None) -> list:
    """For each partition and side of the pivot (0 before, 1 equal, 2 after): how many of the keys
    strictly between the bounds lie there, and their median."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _keys(list(batches))  # 32 bytes a row of one split of the table
        start = _below(own, low)[1] if low else 0
        own = own[start:_below(own, high)[0] if high else len(own)]
        first, last = _below(own, pivot) if pivot else (len(own), len(own))
        out = []
        for side, part in enumerate((own[:first], own[first:last], own[last:])):
            if len(part):
                out.append((side, len(part), *part[(len(part) - 1) // 2].tolist()))
        columns = list(zip(*out)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         names=["side", "n", "a", "b", "c", "d"])

    return keys.mapInArrow(run, "side long, n long, a long, b long, c long, d long").collect()


def _between(keys: DataFrame, low: tuple | None, high: tuple | None) -> DataFrame:
    row = F.struct("a", "b", "c", "d")
    for bound, after in ((low, True), (high, False)):
        if bound:
            other = F.struct(*[F.lit(v).cast("long").alias(n) for v, n in zip(bound, "abcd")])
            # The first field alone reaches the scan.
            keys = (keys.where(F.col("a") >= bound[0]).where(row > other) if after
                    else keys.where(F.col("a") <= bound[0]).where(row < other))
    return keys


def cutoff(keys: DataFrame, rank: int) -> tuple[tuple, int]:
    """The key with `rank` keys up to it (from 1) in rising order, and how many keys are before it.
    `keys` are stored rows (a, b, c, d: long). One row per partition and side reaches the driver in
    each round; rounds grow with the logarithm of the rows."""
    low = high = pivot = None
    before, size, table, last = 0, None, keys, None
    while True:
        medians = _survey(table, low, high, pivot)
        counts = [sum(m[1] for m in medians if m[0] == side) for side in range(3)]
        if size is None:
            last = size = counts[0]
        if pivot is not None:
            if before + counts[0] < rank <= before + counts[0] + counts[1]:
                return pivot, before + counts[0]
            if rank <= before + counts[0]:
                side, high = 0, pivot
            else:
                side, low, before = 2, pivot, before + counts[0] + counts[1]
            size = counts[side]
        else:
            side = 0
        mine = sorted((tuple(m[2:]), m[1]) for m in medians if m[0] == side)
        seen = 0
        for key, n in mine:
            seen += n
            if 2 * seen >= size:
                pivot = key
                break
        if SHRINK * size < last:
            table, last = stored(_between(table, low, high), "keys"), size


def draw(weighed: DataFrame, percent: int = 10, least_words: int = 20) -> DataFrame:
    """`weigh`'s rows with `rank`, 1 for the highest score: floor(percent * N / 100) of the N rows with
    at least `least_words` words are drawn, the others have a null rank."""
    if not 0 <= percent <= 100:
        raise ValueError("a percentage is from 0 to 100")
    rows = stored(weighed, "weighed")
    key = [(-F.col("score")).alias("a"), F.col("doc_id").isNull().cast("long").alias("b"),
           F.coalesce("doc_id", F.lit(_NO_ID)).alias("c"), F.col("n_features").alias("d")]
    entitled = F.col("n_words") >= least_words
    wanted = rows.where(entitled).count() * percent // 100
    if not wanted:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    keys = stored(rows.where(entitled).select(*key), "keys")
    edge, before = cutoff(keys, wanted)
    own, limit = F.struct(*key), F.struct(*[F.lit(v).cast("long").alias(n) for v, n in zip(edge, "abcd")])
    names = weighed.columns
    won, tied = entitled & (own < limit), entitled & (own == limit)
    lost = rows.where(~won & ~tied).withColumn("rank", F.lit(None).cast("long"))
    # Equal rows count as one with a number, so that a third of all rows may be copies.
    winners = rows.where(won).groupBy(*names).agg(F.count("*").alias("copies"))
    out = lost.unionByName(_ranked(winners, names))
    # The rows at the cutoff are interchangeable: as many as are left to draw have a rank.
    copies = rows.where(tied).groupBy(*names).agg(F.count("*").alias("copies"))
    last = _copies(copies.withColumn("first", F.lit(before).cast("long")), names)
    return out.unionByName(last.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))))


def _copies(groups: DataFrame, names: list[str]) -> DataFrame:
    """A row for each of the `copies` of a group, ranked from `first` + 1; in two steps, so that no
    row holds more than a bounded part of them."""
    parts = groups.withColumn("part", F.explode(F.expr(f"sequence(0L, (copies - 1) div {CHUNK})")))
    left = F.least(F.lit(CHUNK).cast("long"), F.col("copies") - F.col("part") * CHUNK)
    many = parts.withColumn("own", F.explode(F.sequence(F.lit(1).cast("long"), left)))
    return many.select(*names, (F.col("first") + F.col("part") * CHUNK + F.col("own")).alias("rank"))


def _ranked(winners: DataFrame, names: list[str]) -> DataFrame:
    """Ranks by running sums of copies: within blocks of the score, and over the blocks' totals."""
    winners = stored(winners.withColumn("place", -F.col("score")), "winners")
    layout = blocks.plan_blocks(winners, "place")
    rows = layout.assign(winners, "place")
    order = [F.col("place"), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("n_words")]
    inside = F.sum("copies").over(blocks.in_block([], *order).rowsBetween(
        Window.unboundedPreceding, 0)) - F.col("copies")
    rows = rows.withColumn("first", inside)
    totals = rows.groupBy(blocks.BLOCK).agg(F.sum("copies").alias("n"))
    shift = totals.select(blocks.BLOCK, F.coalesce(F.sum("n").over(blocks.before([])), F.lit(0)).alias("shift"))
    # At most MAX_BLOCKS rows by construction of the layout.
    rows = rows.join(F.broadcast(shift), blocks.BLOCK).withColumn("first", F.col("first") + F.col("shift"))
    return _copies(rows, names)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, runs: int = 1,
             buckets: int = BUCKETS, seed: str = SEED, id_column: str = "doc_id", text_column: str = "text",
             target_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null where not drawn) of every row."""
    gain = gains(bucket_counts(docs, text_column, runs, buckets), bucket_counts(target, target_text, runs, buckets))
    return draw(weigh(docs, gain, id_column, text_column, runs, seed), percent, least_words)


def drawn(docs: DataFrame, ranked: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The documents whose id has a rank, with all their columns."""
    won = ranked.where("rank is not null").select(F.col("doc_id").alias("_won")).distinct()
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_column].cast("long").alias("own"))
    return row.join(won, F.col("own").eqNullSafe(F.col("_won")), "left_semi").select("row.*")
