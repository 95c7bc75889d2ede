"""Hard negatives for contrastive training, by rotated one-bit codes with exact results.

Vectors become integers, floor(scale * x). A fixed rotation (sign flips and Walsh-Hadamard
transforms, which keep all inner products) spreads them over all coordinates, and a vector's code is
the signs of its coordinates: c, a unit vector with coordinates +-1/sqrt(D). Stored with the code are
the vector's length and its alignment a = <v, c>. With v = a c + r and q = t c + s, where t = <q, c> and r
and s are orthogonal to c, the score is <v, q> = a t + <r, s>, so by Cauchy-Schwarz

    |<v, q> - a t| <= sqrt(|v|^2 - a^2) sqrt(|q|^2 - t^2).

t is estimated by popcounts of the code with the bit planes of the anchor's coordinates, which are cut to
eight bits; what cutting may change is added to the interval, as is a bound for rounding. Rows whose
interval cannot hold a wanted score are left out, all others get their integer score. So results are
those of comparing every anchor with every row.

Anchors are a stated part of the rows. They go to the tasks in blocks of bounded bytes, one block after
another; every task keeps the best few of its rows for each anchor of the block, and these are
merged by Spark. First come the positives (best rows of the anchor's label), then, within a band of
each positive's score, the negatives (best rows of other labels).

Rows with a null id, label or vector, or with any null or non-finite component, take no part. Missing
components of shorter vectors count as zero, also in empty vectors. Of rows with equal id and equal score
for an anchor one counts; no row is a partner of an anchor with its own id. Ties go to the smaller id. Empty
tables give no rows. Ids and labels are integers. Other columns are not read, so their names may
clash with any of ours. Scores must fit 64 bits; larger ones stop the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.tables import lean, ranges, stored, utf8
from tidegauge.operators.ordered import ordered_index

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# A negative's score in hundredths of its positive's, from and to.
BAND = (50, 95)
PLANES = 8
ROUNDS = 3
# Bytes of a block of anchors in a task, rows and anchors compared at a time.
BLOCK_BYTES = 32 << 20
ROWS, ANCHORS = 4096, 64
_LEAST = 1 - (1 << 63)


def rotated(x: np.ndarray, size: int) -> np.ndarray:
    """The rows of x, filled up with zeros to `size` (a power of two), in rotated coordinates."""
    out = np.zeros((len(x), size))
    out[:, :x.shape[1]] = x
    rng = np.random.default_rng(size)
    for _ in range(ROUNDS):
        out *= rng.choice([-1.0, 1.0], size)
        width = 1
        while width < size:
            pairs = out.reshape(len(x), size // (2 * width), 2, width)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), size)
            width *= 2
        out /= np.sqrt(size)
    return out


def _bits(marks: np.ndarray) -> np.ndarray:
    """Rows of marks as rows of 64-bit words."""
    return np.packbits(marks, axis=1, bitorder="little").view(np.uint64)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as rows of `dim` integers, short lists filled up with zeros."""
    sizes = column.value_lengths().to_numpy()
    values = column.flatten().to_numpy()
    if len(sizes) and (sizes == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros(len(sizes) * dim, np.int64)
    out[ranges(np.arange(len(sizes)) * dim, sizes)] = values
    return out.reshape(-1, dim)


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [
        None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.py_buffer(np.ascontiguousarray(rows))])


def index(vectors: DataFrame, anchors: Column, scale: int = SCALE, id_column: str = "vec_id",
          vector_column: str = "embedding", label_column: str = "label") -> tuple[DataFrame, int, int]:
    """The stored rows that take part (vec_id, label, v: integers, code, length, alignment, anchor), the
    largest dimension and that of the codes."""
    x = F.col(vector_column)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    rows = vectors.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("long").alias("label"),
        whole.alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 1
    size = max(64, 1 << (dim - 1).bit_length())

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            v = _matrix(batch.column(2), dim).astype(float)
            r = rotated(v, size)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _binary(_bits(r > 0)), pa.array(np.sqrt((v * v).sum(axis=1))),
                 pa.array(np.abs(r).sum(axis=1) / np.sqrt(size))],
                names=[*batch.schema.names, "code", "length", "alignment"])

    schema = "vec_id long, label long, v array<long>, anchor boolean, code binary, length double, alignment double"
    return stored(rows.mapInArrow(run, schema), "codes"), dim, size


@dataclass
class Block:
    """Anchors of a block: ids, labels, integer vectors, lengths, and their rotated coordinates as bit
    planes: low + step * (plane 0 + 2 * plane 1 + ...), off by `off` at most in a sum over signs."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    length: np.ndarray
    planes: np.ndarray
    low: np.ndarray
    step: np.ndarray
    total: np.ndarray
    off: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, size: int) -> Block:
        r = rotated(v, size)
        low, high = r.min(axis=1), r.max(axis=1)
        step = np.maximum((high - low) / (2 ** PLANES - 1), 1e-300)
        level = np.clip(np.rint((r - low[:, None]) / step[:, None]), 0, 2 ** PLANES - 1).astype(np.int64)
        cut = low[:, None] + step[:, None] * level
        planes = np.stack([_bits((level >> p & 1).astype(bool)) for p in range(PLANES)], axis=1)
        return cls(ids, labels, v, np.sqrt((v.astype(float) ** 2).sum(axis=1)), planes, low, step, cut.sum(axis=1),
                   np.abs(r - cut).sum(axis=1))


@dataclass
class Rows:
    """Rows that anchors are compared with."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    code: np.ndarray
    length: np.ndarray
    alignment: np.ndarray

    def part(self, which: np.ndarray | slice) -> Rows:
        return Rows(self.ids[which], self.labels[which], self.v[which], self.code[which], self.length[which],
                    self.alignment[which])


def bounds(block: Block, which: np.ndarray, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest score that each of some anchors may have with each row."""
    size = 64 * rows.code.shape[1]
    ones = np.bitwise_count(rows.code).sum(axis=1, dtype=np.int64)
    weighted = np.zeros((len(which), len(rows.ids)), np.int64)
    for p in range(PLANES):
        common = np.bitwise_count(rows.code[None] & block.planes[which, p][:, None])
        weighted += (common[..., 0] if common.shape[2] == 1 else common.sum(axis=2)).astype(np.int64) << p
    # Sum of the coordinates with a positive sign, less those with a negative one.
    positive = block.low[which, None] * ones + block.step[which, None] * weighted
    t = (2 * positive - block.total[which, None]) / np.sqrt(size)
    off = block.off[which, None] / np.sqrt(size)
    apart = np.sqrt(np.maximum(rows.length ** 2 - rows.alignment ** 2, 0))
    rest = np.sqrt(np.maximum(block.length[which, None] ** 2 - np.maximum(np.abs(t) - off, 0) ** 2, 0))
    # Rounding is far below a billionth of the lengths.
    slack = apart * rest + rows.alignment * off + 1e-9 * block.length[which, None] * rows.length + 1e-6
    middle = rows.alignment * t
    return middle - slack, middle + slack


class Scorer:
    """Exact scores of rows with an anchor: in doubles where these hold all sums, else in integers."""

    def __init__(self, block: Block, rows: Rows):
        most = int(np.abs(block.v).max(initial=0)) * int(np.abs(rows.v).max(initial=0)) * max(1, block.v.shape[1])
        if most >= 1 << 63:
            raise ValueError("scores do not fit 64 bits")
        kind = np.float64 if most < 1 << 53 else np.int64
        self.a, self.v = block.v.astype(kind, copy=False), rows.v.astype(kind)

    def __call__(self, anchor: int, which: np.ndarray) -> np.ndarray:
        return (self.v[which] @ self.a[anchor]).astype(np.int64)


class Best:
    """The best few (score, id) of each of many lists."""

    def __init__(self, lists: int, few: int):
        self.few = few
        self.score = np.full((lists, few), _LEAST, np.int64)
        self.ids = np.zeros((lists, few), np.int64)

    def add(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.score[i, -1]
        if not good.any():
            return
        score, ids = np.concatenate([self.score[i], score[good]]), np.concatenate([self.ids[i], ids[good]])
        if len(score) > 4 * self.few:
            least = np.unique(score)[-self.few:][0]
            score, ids = score[score >= least], ids[score >= least]
        order = np.lexsort((ids, -score))
        score, ids = score[order], ids[order]
        # Repeated rows count once; empty places stay apart.
        new = np.concatenate([[True], (score[1:] != score[:-1]) | (ids[1:] != ids[:-1]) | (score[1:] == _LEAST)])
        if new.sum() >= self.few:
            score, ids = score[new], ids[new]
        else:
            score = np.concatenate([score[new], np.full(self.few, _LEAST)])
            ids = np.concatenate([ids[new], np.zeros(self.few, np.int64)])
        self.score[i], self.ids[i] = score[:self.few], ids[:self.few]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.score.ravel() != _LEAST)
        return at // self.few, self.ids.ravel()[at], self.score.ravel()[at]


def _rows_of(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[Rows]:
    for batch in batches:
        ids, labels, length, alignment = (batch.column(c).to_numpy() for c in ("vec_id", "label", "length", "alignment"))
        v, code = _matrix(batch.column("v"), dim), utf8(batch.column("code"))[0]
        rows = Rows(ids, labels, v, code.view(np.uint64).reshape(len(ids), -1), length, alignment)
        for i in range(0, len(ids), ROWS):
            yield rows.part(slice(i, i + ROWS))


def best_positives(block: Block, many: Iterator[Rows], few: int) -> Best:
    """The best rows of each anchor's label."""
    best = Best(len(block.ids), few)
    by_label: dict[int, np.ndarray] = {}
    order = np.argsort(block.labels, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(block.labels[order])) + 1):
        if len(part):
            by_label[int(block.labels[part[0]])] = part
    for rows in many:
        score = Scorer(block, rows)
        for label in np.unique(rows.labels).tolist():
            anchors = by_label.get(label)
            if anchors is None:
                continue
            own = np.flatnonzero(rows.labels == label)
            part = rows.part(own)
            for i in range(0, len(anchors), ANCHORS):
                which = anchors[i:i + ANCHORS]
                high = bounds(block, which, part)[1]
                for n, a in enumerate(which.tolist()):
                    left = np.flatnonzero((high[n] >= best.score[a, -1]) & (part.ids != block.ids[a]))
                    if len(left):
                        best.add(a, score(a, own[left]), part.ids[left])
    return best


def best_negatives(block: Block, many: Iterator[Rows], places: np.ndarray, wanted: np.ndarray, few: int,
                   band: tuple[int, int]) -> Best:
    """The best rows of other labels in the band of each positive. `places`: where each anchor's
    positives begin in `wanted`, their scores."""
    best = Best(len(wanted), few)
    for rows in many:
        score = Scorer(block, rows)
        for i in range(0, len(block.ids), ANCHORS):
            which = np.arange(i, min(i + ANCHORS, len(block.ids)))
            which = which[places[which + 1] > places[which]]
            if not len(which):
                continue
            low, high = bounds(block, which, rows)
            for n, a in enumerate(which.tolist()):
                own = range(places[a], places[a + 1])
                # A score below the band or the few best of every positive is not wanted.
                least = min(max(band[0] * wanted[p] / 100, float(best.score[p, -1])) for p in own)
                most = max(band[1] * wanted[p] / 100 for p in own)
                left = np.flatnonzero((high[n] >= least) & (low[n] <= most) & (rows.labels != block.labels[a])
                                      & (rows.ids != block.ids[a]))
                if not len(left):
                    continue
                s, ids = score(a, left), rows.ids[left]
                for p in own:
                    ps = int(wanted[p])
                    # band[0] * ps <= 100 * s <= band[1] * ps in whole numbers.
                    inside = (s >= -(-band[0] * ps // 100)) & (s <= band[1] * ps // 100)
                    if inside.any():
                        best.add(p, s[inside], ids[inside])
    return best


_USED = ("vec_id", "label", "v", "code", "length", "alignment")


def _blocks(codes: DataFrame, dim: int, size: int, block_bytes: int) -> Iterator[Block]:
    """The distinct anchors in blocks of bounded bytes, in order of their ids."""
    anchors = stored(codes.where("anchor").select("vec_id", "label", "v").distinct(), "anchors")
    most = max(1, block_bytes // (24 * dim + PLANES * size // 8))
    count = anchors.count()
    if count > most:
        numbered = ordered_index(anchors, [F.col("vec_id"), F.col("label"), F.col("v")], "vec_id")
        anchors = stored(numbered.withColumn("block", F.expr(f"(i - 1) div {most}")), "anchors")
    for i in range(-(-count // most)):
        rows = (anchors.where(F.col("block") == i) if count > most else anchors).select("vec_id", "label", "v").collect()
        rows.sort()
        v = np.zeros((len(rows), dim), np.int64)
        for r, row in zip(v, rows):
            r[:len(row[2])] = row[2]
        yield Block.of(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), v, size)


def _best_of(found: DataFrame, keys: list[str], few: int) -> DataFrame:
    """The best few of the tasks' lists, repeated rows once, with their place from 1."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= few)


def mine(vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         band: tuple[int, int] = BAND, scale: int = SCALE, id_column: str = "vec_id", vector_column: str = "embedding",
         label_column: str = "label", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for each row
    with `anchors` and each of its best rows of the same label, the best rows of other labels whose score
    is within `band` hundredths of the positive's."""
    spark = vectors.sparkSession
    codes, dim, size = index(vectors, anchors, scale, id_column, vector_column, label_column)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = None
    for block in _blocks(codes, dim, size, block_bytes):
        # Plain values: workers need not have this package.
        spread = spark.sparkContext.broadcast(tuple(getattr(block, f.name) for f in fields(block)))

        @lean
        def near(batches: Iterator[pa.RecordBatch], spread=spread) -> Iterator[pa.RecordBatch]:
            a, ids, score = best_positives(Block(*spread.value), _rows_of(batches, dim), positives).rows()
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(ids), pa.array(score)], names=["a", "id", "score"])

        found = _best_of(codes.select(*_USED).mapInArrow(near, "a long, id long, score long"), ["a"], positives)
        # At most `positives` rows for each anchor of the block.
        pairs = sorted(found.select("a", "place", "id", "score").collect())
        a = np.array([p[0] for p in pairs], np.int64)
        places = np.searchsorted(a, np.arange(len(block.ids) + 1))
        wanted = np.array([p[3] for p in pairs], np.int64)
        asked = spark.sparkContext.broadcast((places, wanted))

        @lean
        def far(batches: Iterator[pa.RecordBatch], spread=spread, asked=asked) -> Iterator[pa.RecordBatch]:
            p, ids, score = best_negatives(Block(*spread.value), _rows_of(batches, dim), *asked.value, negatives, band).rows()
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(ids), pa.array(score)], names=["p", "id", "score"])

        if not pairs:
            spread.destroy()
            continue
        best = _best_of(codes.select(*_USED).mapInArrow(far, "p long, id long, score long"), ["p"], negatives)
        # The pairs are bounded as above.
        names = F.broadcast(spark.createDataFrame(pa.table({
            "p": np.arange(len(pairs)), "anchor_id": block.ids[a], "positive_id": np.array([p[2] for p in pairs], np.int64),
            "positive_score": wanted})))
        rows = stored(best.join(names, "p").select(
            "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")), "negatives")
        spread.destroy()
        asked.destroy()
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out
