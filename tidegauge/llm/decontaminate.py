"""Benchmark passages inside documents, by q-gram counting and banded alignment.

An item of m characters that occurs with at most k edits keeps at least m - q + 1 - q * k of its
q-grams, all on diagonals at most k apart. So shared q-grams are counted in diagonal bands that
overlap by half and are more than k wide each half, each q-gram of the item once; bands that
reach the bound are kept, and an alignment limited to the band decides.

Items and documents are compared in lower case (A-Z) with all ASCII white space as spaces. The
edit budget is `rate` of an item's length, or what leaves 15 % of its q-grams if that is less.
Items of fewer than `SHORT_CHARS` characters have to occur without edits and between word
boundaries; those without a single q-gram (fewer than `Q` characters) identify no passage. Items of more
than `LONG_CHARS` are searched in windows that overlap by half, so excerpts of them are found too;
windows found next to each other are one occurrence, whose distance is that of its worst window.

Documents are not shuffled. Items are broadcast in blocks of at most `BLOCK_CHARS` characters (one longer
item is a block). Of several blocks one is broadcast at a time: its results are stored and
it is given up before the next, so what is broadcast has a bound whatever the benchmark's size.

Nulls: a null text is an empty one; null ids stay. Repeated rows and items are reported each. Empty
tables give no rows. Texts are searched whole. Only named columns are used, so other
columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import carried, lean, mapped, stored, text_of
from tidegauge.session import fits_broadcast

Q = 8
RATE = 0.1
SHORT_CHARS = 24
LONG_CHARS = 400
WINDOW_CHARS = 200
BLOCK_CHARS = 4_000_000
# Characters of documents that are worked on at a time.
STEP_CHARS = 1 << 21
BROADCAST_ROWS = 500_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def code_points(text: str) -> np.ndarray:
    """Code points in lower case, white space as spaces."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where((c >= 65) & (c <= 90), c + 32, c)
    return np.where((c >= 9) & (c <= 13), np.uint32(32), c)


def _grams(codes: np.ndarray) -> np.ndarray:
    """The q-gram at each position, with code points folded to bytes. Equal q-grams stay equal;
    others may become so, which only adds candidates."""
    a = np.where(codes < 128, codes, (codes ^ (codes >> 7)) & 127 | 128).astype(np.uint8)
    if len(a) < Q:
        return np.zeros(0, np.uint64)
    two = a[:-1].astype(np.uint16) | a[1:].astype(np.uint16) << np.uint16(8)
    four = two[:-2].astype(np.uint32) | two[2:].astype(np.uint32) << np.uint32(16)
    return four[:-4].astype(np.uint64) | four[4:].astype(np.uint64) << np.uint64(32)


def budget(length: int, rate: float = RATE) -> int:
    if length < SHORT_CHARS:
        return 0
    return max(0, min(int(rate * length), int((0.85 * length - Q + 1) // Q)))


@dataclass
class Index:
    """The q-grams of a block of patterns, sorted; `item` and `at` give each one's places. A pattern is an
    item or a window of one (`owner`)."""

    ids: list
    owner: np.ndarray
    codes: list[np.ndarray]
    budgets: np.ndarray
    least: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    at: np.ndarray
    shift: np.uint64
    seen: np.ndarray


def _windows(codes: np.ndarray) -> list[np.ndarray]:
    """A long item in windows that overlap by half, the last one up to its end."""
    if len(codes) <= LONG_CHARS:
        return [codes]
    starts = [*range(0, len(codes) - WINDOW_CHARS, WINDOW_CHARS // 2), len(codes) - WINDOW_CHARS]
    return [codes[s:s + WINDOW_CHARS] for s in starts]


def make_index(items: list[tuple[object, str]], rate: float = RATE) -> Index | None:
    patterns = [(n, c) for n, (_, t) in enumerate(items) for c in _windows(code_points(t)) if len(c) >= Q]
    if not patterns:
        return None
    ids, owner, codes = [i for i, _ in items], np.array([n for n, _ in patterns]), [c for _, c in patterns]
    budgets = np.array([budget(len(c), rate) for c in codes])
    grams = [_grams(c) for c in codes]
    sizes = np.array([len(g) for g in grams])
    flat = np.concatenate(grams)
    order = np.argsort(flat, kind="stable")
    item = np.repeat(np.arange(len(codes)), sizes)[order]
    at = np.concatenate([np.arange(n) for n in sizes])[order]
    distinct, first = np.unique(flat[order], return_index=True)
    bits = min(27, max(16, (24 * len(distinct)).bit_length()))
    seen = np.zeros(1 << bits, bool)
    shift = np.uint64(64 - bits)
    seen[distinct * _MULTIPLIER >> shift] = True
    return Index(ids, owner, codes, budgets, sizes - Q * budgets, distinct, np.append(first, len(flat)), item, at, shift, seen)


def align(pattern: np.ndarray, text: np.ndarray, most: int, anchored: bool = False) -> tuple[int, int] | None:
    """(distance, end) of the pattern's best occurrence in the text with at most `most` edits, the
    first end among equals; it may begin anywhere, or at 0 if `anchored`. Cells are kept by
    diagonal, and there are as many as the text is longer than the pattern, plus `most` on
    either side."""
    m, n = len(pattern), len(text)
    width = max(0, n - m) + 2 * most + 1
    far = np.int64(m + n + 1)
    diagonal = np.arange(width) - most
    step = np.arange(width)
    row = np.where((diagonal >= 0) & (diagonal <= n), diagonal if anchored else 0, far).astype(np.int64)
    padded = np.concatenate([np.full(most, 0xFFFFFFFF, np.uint32), text, np.full(m + width, 0xFFFFFFFF, np.uint32)])
    for i in range(m):
        end = diagonal + i + 1
        new = row + (padded[i:i + width] != pattern[i])
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new = np.where((end >= 0) & (end <= n), new, far)
        if i + 1 <= most:
            new = np.where(end == 0, i + 1, new)
        new = np.minimum.accumulate(new - step) + step
        row = np.where((end >= 0) & (end <= n), new, far)
        if row.min() > most:
            return None
    best = int(np.argmin(row))
    return int(row[best]), int(diagonal[best] + m)


def _bounded(codes: np.ndarray, start: int, end: int) -> bool:
    """Whether a word neither goes on before nor after."""
    def inside(a: int, b: int) -> bool:
        return 0 <= a and b < len(codes) and chr(codes[a]).isalnum() and chr(codes[b]).isalnum()

    return not inside(start - 1, start) and not inside(end - 1, end)


def _verify(index: Index, item: int, codes: np.ndarray, low: int, high: int) -> tuple[int, int, int] | None:
    """(start, end, distance) of the item in codes[low:high]."""
    pattern, k = index.codes[item], int(index.budgets[item])
    low, high = max(0, low), min(len(codes), high)
    region = codes[low:high]
    raw, wanted, at = region.tobytes(), pattern.tobytes(), -1
    while (at := raw.find(wanted, at + 1)) >= 0:
        start, end = low + at // 4, low + at // 4 + len(pattern)
        if at % 4 == 0 and (len(pattern) >= SHORT_CHARS or _bounded(codes, start, end)):
            return start, end, 0
    if len(pattern) < SHORT_CHARS:
        return None
    found = align(pattern, region, k)
    if found is None or found[0] > k:
        return None
    distance, end = found
    back = align(pattern[::-1], region[max(0, end - len(pattern) - k):end][::-1], k, anchored=True)
    return low + end - back[1], low + end, distance


def find(index: Index, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text number, item number, start, end, distance) of all items in some texts, in code
    points. Of overlapping occurrences of an item in a text the closest is given; those of the windows
    of an item are joined."""
    codes = [code_points(t) for t in texts]
    sizes = np.array([len(c) for c in codes])
    starts = np.cumsum(sizes) - sizes
    grams = _grams(np.concatenate(codes)) if len(codes) else np.zeros(0, np.uint64)
    place = np.flatnonzero(index.seen[grams * _MULTIPLIER >> index.shift])
    which = np.searchsorted(index.grams, grams[place])
    same = index.grams[np.minimum(which, len(index.grams) - 1)] == grams[place]
    place, which = place[same], which[same]
    text = np.searchsorted(starts, place, side="right") - 1
    inside = place - starts[text] + Q <= sizes[text]
    place, which, text = place[inside], which[inside], text[inside]
    counts = index.first[which + 1] - index.first[which]
    ends = np.cumsum(counts)
    entry = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(index.first[which] - (ends - counts), counts)
    item = index.item[entry]
    pair = np.repeat(text, counts) * len(index.codes) + item
    # Pairs with too few hits in all need no bands.
    pairs, number, hits = np.unique(pair, return_inverse=True, return_counts=True)
    enough = (hits >= index.least[pairs % len(index.codes)])[number]
    item = item[enough]
    at = index.at[entry][enough]
    diagonal = (np.repeat(place - starts[text], counts))[enough] - at
    half = index.budgets[item] + 1
    band = diagonal // half
    # Each q-gram of an item once per band: one number for (pair, band), one with the q-gram.
    low = int(band.min(initial=0)) - 1
    bands = int(band.max(initial=0)) - low + 1
    both = np.concatenate([number[enough] * bands + band - low, number[enough] * bands + band - 1 - low])
    groups, group = np.unique(both, return_inverse=True)
    longest = max(len(c) for c in index.codes)
    once = np.unique(group * longest + np.concatenate([at, at])) // longest
    shared = np.bincount(once, minlength=len(groups))
    groups = np.stack([pairs[groups // bands], groups % bands + low])
    groups = groups[:, shared >= index.least[groups[0] % len(index.codes)]]
    best: dict[int, list[tuple[int, int, int]]] = {}
    for p, b in groups.T.tolist():
        t, i = divmod(p, len(index.codes))
        k = int(index.budgets[i])
        found = _verify(index, i, codes[t], b * (k + 1) - k, (b + 2) * (k + 1) + len(index.codes[i]) + k)
        if found:
            best.setdefault(p, []).append(found)
    out = []
    for p, found in best.items():
        kept: list[tuple[int, int, int]] = []
        for s, e, d in sorted(set(found), key=lambda f: (f[2], f[0])):
            if all(e <= s2 or s >= e2 for s2, e2, _ in kept):
                kept.append((s, e, d))
        out += [(*divmod(p, len(index.codes)), *f) for f in sorted(kept)]
    return _joined(index, out)


def _joined(index: Index, found: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Patterns to items: windows of one item that overlap or touch are one occurrence."""
    out: list[tuple[int, int, int, int, int]] = []
    windows = np.bincount(index.owner)
    for text, item, start, end, distance in sorted((t, int(index.owner[p]), s, e, d) for t, p, s, e, d in found):
        if windows[item] > 1 and out and out[-1][:2] == (text, item) and start <= out[-1][3]:
            out[-1] = (text, item, out[-1][2], max(end, out[-1][3]), max(distance, out[-1][4]))
        else:
            out.append((text, item, start, end, distance))
    return out


def _in_steps(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Slices of a column with about STEP_CHARS characters, at least one text each."""
    held: list[str] = []
    size = first = 0
    for i, text in enumerate(texts):
        text = text.as_py()
        if held and size + len(text) > STEP_CHARS:
            yield first, held
            held, size, first = [], 0, i
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def _blocks(items: DataFrame, id_column: str, text_column: str, rate: float) -> tuple[int, Iterator[Broadcast]]:
    """How many blocks of items there are, and their indexes, broadcast one after another."""
    rows = items.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    blocks = 1 + (rows.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS

    def indexes() -> Iterator[Broadcast]:
        for b in range(blocks):
            own = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
            index = make_index([tuple(r) for r in own.collect()], rate)
            if index:
                # Plain values: workers need not have this package.
                yield items.sparkSession.sparkContext.broadcast(tuple(getattr(index, f.name) for f in fields(index)))

    return blocks, indexes()


def _by_block(blocks: int, indexes: Iterator[Broadcast], search: Callable[[Broadcast], DataFrame]) -> DataFrame | None:
    """The rows that `search` gives for all blocks; of several, each is stored and its index given up."""
    out = None
    for index in indexes:
        part = search(index)
        if blocks > 1:
            part = stored(part, "block")
            index.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def occurrences(docs: DataFrame, items: DataFrame, rate: float = RATE, id_column: str = "doc_id",
                text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, start, end (code points of the whole text), distance of each occurrence."""
    types = dict(docs.dtypes)[id_column], dict(items.dtypes)[item_column]
    schema = f"doc_id {types[0]}, item_id {types[1]}, start long, end long, distance long"
    rows = docs.select(F.col(id_column), text_of(text_column).alias("text"))

    def search(index: Broadcast) -> DataFrame:
        @lean
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = Index(*index.value)
            for batch in batches:
                found = [(first + t, *rest) for first, texts in _in_steps(batch.column(1))
                         for t, *rest in find(block, texts)]
                doc = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                item = pa.array([block.ids[f[1]] for f in found])
                yield pa.RecordBatch.from_arrays(
                    [doc, item.cast(pa.int64()) if not found else item,
                     *(pa.array([f[c] for f in found], pa.int64()) for c in (2, 3, 4))],
                    names=["doc_id", "item_id", "start", "end", "distance"])

        return rows.mapInArrow(run, schema)

    out = _by_block(*_blocks(items, item_column, item_text, rate), search)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE, text_column: str = "text",
          item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without any benchmark passage, with all their columns. With several blocks of items
    the texts that hold one are named by digest, and the documents are joined with these."""
    place = docs.columns.index(text_column)

    def marks(block: Index, texts: pa.Array) -> np.ndarray:
        keep = np.ones(len(texts), bool)
        for first, part in _in_steps(texts):
            for t, *_ in find(block, part):
                keep[first + t] = False
        return keep

    blocks, indexes = _blocks(items, item_column, item_text, rate)
    if blocks == 1:
        for index in indexes:
            @lean
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                block = Index(*index.value)
                for batch in batches:
                    yield batch.filter(pa.array(marks(block, batch.column(place).fill_null(""))))

            return mapped(docs, run)
        return docs
    digest = F.sha2(text_of(text_column).cast("binary"), 256)
    rows = docs.select(digest.alias("digest"), text_of(text_column).alias("text"))

    def search(index: Broadcast) -> DataFrame:
        @lean
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = Index(*index.value)
            for batch in batches:
                yield batch.select(["digest"]).filter(pa.array(~marks(block, batch.column(1))))

        return rows.mapInArrow(run, "digest string")

    found = _by_block(blocks, indexes, search)
    if found is None:
        return docs
    found = stored(found.distinct(), "contaminated")
    found = F.broadcast(found) if fits_broadcast(found, BROADCAST_ROWS) else found
    return carried(docs, digest.alias("digest")).join(found, "digest", "left_anti").select("row.*")
