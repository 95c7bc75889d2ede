"""Repeated runs of lines, found by winnowing over line hashes.

A text is a sequence of lines; a long line is cut further after words whose hash says so (one in
`CUT`), and lines of fewer than `SHORT` words are joined to the next one, so equal passages have equal
lines wherever they stand in a text. Every `GRAM` lines in a row are hashed, and the smallest hash (the
last of equals) of every `WINDOW` in a row is a fingerprint. Any run of GRAM + WINDOW - 1 equal
lines in two places has a common fingerprint.

Each fingerprint is shuffled with its position and hashes of the next 1, 2, 4, 6, 8 and 11 lines on either
side (`LEVELS`; where a text begins or ends in between, of what there is). Every occurrence is compared
with all earlier ones (by document id, then text digest, then position): for each level before
it that some earlier place has too, which levels after it one such place has besides. This is done level by level by sorting, so no pairs are made. Each answer is a window of
lines that one earlier place holds as a whole. Windows of at least `min_words` words are deleted from the
later document; where they overlap or touch, as in longer runs, they go as one. So every deleted
word is in a run of `min_words` words or more that stands in one earlier place, and pieces that
only meet by chance are left alone.

Fingerprints are resolved within a batch of documents before the shuffle: of a frequent passage
one row per batch is sent, of a frequent line one per batch and distinct context.

Nulls: a null text is an empty one and becomes it; a null id counts as the largest. Rows with equal
id and text are one document and are treated alike. An empty table gives no rows. Texts are
compared whole. Ids are integers; all other columns are kept, whatever their names, but for one
named as the result column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.tables import carried, lean, mapped, quoted, steps, text_of, utf8

CUT = 2
GRAM = 4
WINDOW = 11
LEVELS = (1, 2, 4, 6, 8, 11)
REACH = len(LEVELS)
SHORT = 4
MIN_WORDS = 30
# Bits of a level in a match.
_BITS = 3
# Bytes of text that are worked on at a time.
STEP_BYTES = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LAST = (1 << 63) - 1
_BASE, _WORD_BASE = 0xD6E8FEB86659FD93, 0xCA5A826395121157


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


class Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, for hashes of slices."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        for name, base in (("up", self.base), ("down", self.inverse)):
            p = getattr(self, name)
            while len(p) <= n:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
            setattr(self, name, p)

    def slices(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each values[start:end], equal for equal slices."""
        self._grow(len(values))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.up[:len(values)], dtype=np.uint64)])
        return _mix((sums[ends] - sums[starts]) * self.down[starts])


class Lines:
    """The lines of some texts: hash, document, first and last word of each; places of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, bytes_: Powers, words: Powers):
        space = _SPACE[data]
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = space[1:] != space[:-1]
        edge[offsets] = True
        edges = np.flatnonzero(edge)
        runs = ~space[edges[:-1]] if len(data) else np.zeros(0, bool)
        self.start, self.end = edges[:-1][runs], edges[1:][runs]
        doc = np.searchsorted(offsets, self.start, side="right") - 1
        word = bytes_.slices(_mix(data.astype(np.uint64) + np.uint64(1)), self.start, self.end)
        line = np.cumsum(data == 10)[self.start] if len(data) else np.zeros(0, np.int64)
        last = np.ones(len(word), bool)
        ended = line[1:] != line[:-1]
        other = doc[1:] != doc[:-1]
        number = np.concatenate([np.zeros(1, np.int64), np.cumsum(ended | other)])[:len(word)]
        words_in = np.bincount(number, minlength=1)[number]
        last[:-1] = (ended & (words_in[:-1] >= SHORT)) | other | (word[:-1] % np.uint64(CUT) == 0)
        self.last = np.flatnonzero(last)
        self.first = np.concatenate([[0], self.last[:-1] + 1]) if len(self.last) else self.last
        self.hash = words.slices(word, self.first, self.last + 1)
        self.doc = doc[self.first]
        n = len(offsets) - 1
        # Lines of document d are bounds[d]:bounds[d + 1].
        self.bounds = np.searchsorted(self.doc, np.arange(n + 1))


def fingerprints(lines: Lines) -> np.ndarray:
    """Numbers of the lines where the chosen grams begin."""
    n = len(lines.hash) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    gram = grams(lines)
    doc = lines.doc[:n]
    valid = doc == lines.doc[GRAM - 1:]
    here = np.flatnonzero(valid)
    gram, doc = gram[here], doc[here]
    chosen = np.zeros(len(here), bool)
    if len(here) >= WINDOW:
        view = np.lib.stride_tricks.sliding_window_view(gram, WINDOW)
        least = WINDOW - 1 - np.argmin(view[:, ::-1], axis=1) + np.arange(len(view))
        chosen[least[doc[:len(view)] == doc[WINDOW - 1:]]] = True
    # Documents with fewer grams than a window.
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(doc))
    for s, e in zip(starts[ends - starts < WINDOW], ends[ends - starts < WINDOW]):
        chosen[e - 1 - int(np.argmin(gram[s:e][::-1]))] = True
    return here[chosen]


def grams(lines: Lines) -> np.ndarray:
    n = len(lines.hash) - GRAM + 1
    out = np.zeros(n, np.uint64)
    for i in range(GRAM):
        out = _mix(out + lines.hash[i:i + n])
    return out


def _context(lines: Lines, at: np.ndarray) -> np.ndarray:
    """Hashes (32 bits) of the lines up to each level before and after the gram at each position; 0
    where the document has no more lines than the level before."""
    ends = lines.bounds[lines.doc[at]], lines.bounds[lines.doc[at] + 1]
    out = np.zeros((len(at), 2 * REACH), np.uint32)
    for side, (step, first, left) in enumerate(((-1, at - 1, at - ends[0]), (1, at + GRAM, ends[1] - at - GRAM))):
        sums, level, last = np.zeros(len(at), np.uint64), 0, 0
        for i in range(LEVELS[-1]):
            here = np.flatnonzero(left > i)
            sums[here] = _mix(sums[here] + lines.hash[first[here] + step * i] + np.uint64(1))
            if i + 1 == LEVELS[level]:
                value = np.where(left > i, sums, _mix(sums + np.uint64(_BASE))) >> np.uint64(32)
                out[:, side * REACH + level] = np.where(left > last, value.astype(np.uint32) | np.uint32(1), 0)
                level, last = level + 1, i + 1
    return out


def _levels(code: np.ndarray, rows: np.ndarray, side: np.ndarray):
    """For each level of a side (nearest first): the rows that have it, a code that is
    equal for rows equal up to there, and which have an earlier one. Rows that are alone end."""
    for level in range(REACH + 1):
        if level:
            inside = side[rows, level - 1] != 0
            rows, code = rows[inside], code[inside]
            code = code.astype(np.uint64) << np.uint64(32) | side[rows, level - 1]
        _, first, code = np.unique(code, return_index=True, return_inverse=True)
        seen = first[code] < np.arange(len(rows))
        yield level, rows, code, seen
        many = np.bincount(code, minlength=1)[code] > 1
        rows, code = rows[many], code[many]


def _agreement(group: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each row and level before it: the last level after it of an earlier row of its group that has
    the one before it too; -1 where there is none."""
    out = np.full((len(group), REACH + 1), -1, np.int64)
    for before, rows, code, seen in _levels(group, np.arange(len(group)), left):
        if not seen.any():
            break
        for after, own, _, found in _levels(code, rows, right):
            out[own[found], before] = after
            if not found.any():
                break
    return out


def _packed(agreement: np.ndarray) -> np.ndarray:
    """The windows of each row in one number. Those that another one holds are left out."""
    out, best = np.zeros(len(agreement), np.int64), np.full(len(agreement), -1, np.int64)
    for before in range(REACH, -1, -1):
        own = agreement[:, before]
        out |= np.where(own > best, own + 1, 0) << (_BITS * before)
        best = np.maximum(best, own)
    return out


def _windows(packed: int) -> Iterator[tuple[int, int]]:
    """Levels (before, after)."""
    for before in range(REACH + 1):
        after = (packed >> _BITS * before & (1 << _BITS) - 1) - 1
        if after >= 0:
            yield before, after


def _resolve(key: np.ndarray, ident: np.ndarray, at: np.ndarray, context: np.ndarray, order: np.ndarray):
    """In sorted order: the rows that others have to be compared with, and the rows of a key but for its
    first, with their windows. Rows that an earlier one holds with all their context are no heads: the
    first row with that context is one."""
    if not len(order):
        return order, order, np.zeros(0, np.int64), np.zeros(0, bool)
    k, d, x = key[order], ident[order], at[order]
    # The same place of one document, from equal rows, counts once.
    once = np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1]) | (x[1:] != x[:-1])])
    order = order[once]
    k = key[order]
    new = np.concatenate([[True], k[1:] != k[:-1]])
    group = np.cumsum(new) - 1
    shared = np.flatnonzero((np.bincount(group) > 1)[group])
    sides = context[order[shared]]
    agreement = _agreement(group[shared], sides[:, :REACH], sides[:, REACH:])
    later = agreement[:, 0] >= 0
    levels = (sides[:, :REACH] != 0).sum(axis=1), (sides[:, REACH:] != 0).sum(axis=1)
    whole = later & (agreement[np.arange(len(shared)), levels[0]] == levels[1])
    head = np.ones(len(order), bool)
    head[shared[whole]] = False
    return order[head], order[shared[later]], _packed(agreement[later]), whole[later]


_ROW = "key long, doc long, at long, context binary"
_MATCH = "doc long, at long, windows int"


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [
        None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.py_buffer(np.ascontiguousarray(rows))])


def _document(text: Column) -> Column:
    """32 bits of a text's digest, in the upper half of a number whose lower half is a position."""
    return F.shiftleft(F.xxhash64(text), 32)


def matches(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc, at, windows): in the document with that id (a null one as the largest number) and the text
    digest in the upper half of `at`, windows around the gram at the line in the lower half that an
    earlier place holds."""
    rows = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)).alias("doc"),
                       _document(text_of(text_column)).alias("xx"), text_of(text_column).alias("text"))

    @lean
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(_BASE), Powers(_WORD_BASE)
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            docs_, xxs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found = []
            for i, j in steps(offsets, STEP_BYTES):
                lines = Lines(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], *powers)
                at = fingerprints(lines)
                doc = lines.doc[at]
                found.append((grams(lines)[at].view(np.int64) if len(at) else np.zeros(0, np.int64), doc + i,
                              at - lines.bounds[doc], _context(lines, at)))
            if not found:
                continue
            key, doc, pos, context = (np.concatenate(x) for x in zip(*found))
            ident, at = docs_[doc], xxs[doc] | pos
            order = np.lexsort((at, ident, key))
            heads, later, windows, whole = _resolve(key, ident, at, context, order)
            later, windows = later[whole], windows[whole]
            # Resolved rows need no partner; they travel under their document's digest.
            for part, k, c in ((heads, key[heads], context[heads]), (later, at[later], windows.astype(np.int32)[:, None])):
                for s in range(0, len(part), 100_000):
                    p = part[s:s + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k[s:s + 100_000]), pa.array(ident[p]), pa.array(at[p]), _binary(c[s:s + 100_000])],
                        names=["key", "doc", "at", "context"])

    @lean
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            size = np.diff(utf8(batch.column(3))[1])
            ready = batch.filter(pa.array(size == 4))
            if len(ready):
                yield pa.RecordBatch.from_arrays(
                    [*ready.columns[1:3], pa.array(utf8(ready.column(3))[0].view(np.int32))], names=["doc", "at", "windows"])
            batch = batch.filter(pa.array(size != 4))
            if not len(batch):
                continue
            key, ident, at = (batch.column(c).to_numpy() for c in range(3))
            context = utf8(batch.column(3))[0].view(np.uint32).reshape(-1, 2 * REACH)
            known = 0
            if head is not None:
                known = len(head[0])
                key, ident, at = (np.concatenate([h, x]) for h, x in zip(head[:3], (key, ident, at)))
                context = np.concatenate([head[3], context])
            heads, later, windows, _ = _resolve(key, ident, at, context, np.arange(len(key)))
            # The heads of the last key stay for the next batch, which may go on with it.
            last = heads[key[heads] == key[-1]]
            head = key[last], ident[last], at[last], context[last]
            fresh = later >= known
            later, windows = later[fresh], windows[fresh]
            yield pa.RecordBatch.from_arrays([pa.array(ident[later]), pa.array(at[later]), pa.array(windows.astype(np.int32))],
                                             names=["doc", "at", "windows"])

    sent = rows.mapInArrow(sketch, _ROW).repartition("key").sortWithinPartitions("key", "doc", "at")
    return sent.mapInArrow(compare, _MATCH)


def _cut(text: bytes, found: list[dict], min_words: int, powers: tuple[Powers, Powers]) -> tuple[bytes, list]:
    """The text without its repeated runs, and (start, end) of what went, in bytes."""
    data = np.frombuffer(text, np.uint8)
    lines = Lines(data, np.array([0, len(data)]), *powers)
    marks, many = np.zeros(len(lines.hash) + 1, np.int64), (0, *LEVELS)
    for f in found:
        for before, after in _windows(f["windows"]):
            a, b = max(0, f["pos"] - many[before]), min(len(lines.hash), f["pos"] + GRAM + many[after])
            if lines.last[b - 1] - lines.first[a] + 1 >= min_words:
                marks[a] += 1
                marks[b] -= 1
    covered = np.cumsum(marks[:-1]) > 0
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    kept, gone, at = [], [], 0
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
        start, end = int(lines.start[lines.first[a]]), int(lines.end[lines.last[b - 1]])
        gone.append((start, end))
        after = int(lines.start[lines.last[b - 1] + 1]) if lines.last[b - 1] + 1 < len(lines.start) else len(text)
        kept.append(text[at:start])
        # White space after the run goes with it, but a line that began before it still ends.
        if b"\n" in text[end:after] and start and text[start - 1:start] != b"\n":
            kept.append(b"\n")
        at = after
    return b"".join([*kept, text[at:]]), gone


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id",
                text_column: str = "text", removed_column: str = "_removed") -> DataFrame:
    """`docs` with the repeated runs deleted from the text and `removed_column`, their (start, end) in
    code points of the text before; a column of that name is replaced. No row is dropped; a text may
    become empty."""
    names = [c for c in docs.columns if c != removed_column]
    found = matches(docs, id_column, text_column).select(
        "doc", F.shiftleft(F.shiftright("at", 32), 32).alias("xx"),
        F.struct(F.col("at").bitwiseAND(0xFFFFFFFF).cast("int").alias("pos"), "windows").alias("match")).groupBy("doc", "xx").agg(
        F.collect_list("match").alias("found"))
    kept = docs.select(*[F.col(quoted(c)) for c in names])
    keyed = carried(kept, F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)).alias("key"),
                    _document(text_of(text_column)).alias("digest"))
    joined = keyed.join(found, (F.col("key") == F.col("doc")) & (F.col("digest") == F.col("xx")), "left").select("row", "found")
    place = names.index(text_column)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(_BASE), Powers(_WORD_BASE)
        for batch in batches:
            changed, removed = {}, [[] for _ in range(batch.num_rows)]
            columns = batch.column(0).flatten()
            columns[place] = columns[place].fill_null("")
            lists = batch.column(1)
            for i in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)).tolist():
                text = columns[place][i].as_buffer().to_pybytes()
                new, gone = _cut(text, lists[i].as_py(), min_words, powers)
                if gone:
                    changed[i] = new.decode()
                    count = lambda b, text=text: len(text[:b].decode())
                    removed[i] = [{"start": count(s), "end": count(e)} for s, e in gone]
            if changed:
                texts = columns[place].to_pylist()
                for i, new in changed.items():
                    texts[i] = new
                columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, span)],
                                             names=[str(i) for i in range(len(columns) + 1)])

    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*kept.schema.fields, T.StructField(removed_column, spans)])
    return mapped(joined, run, schema)
