"""Toxicity scores by weak supervision.

1. Lexicons: a short list of common insults, and what a bounded sample of labelled training rows
   shows: word beginnings and whole words (of unspaced scripts and very long words, character n-grams
   at all positions) that occur in far more toxic documents than chance allows. Words end at any mark that is
   no letter or digit, also beyond ASCII. These entries are dealt to `LEXICONS` lexicon voters in order of their share of
   toxic documents, the surest to the first, so that no voter mixes sure entries with weak ones; pattern voters look at form.
2. Every document gets its votes. A generative model is fitted to the counts of all vote patterns of the
   corpus by expectation maximisation. Each class, toxic and clean, is a mixture of kinds, and in each kind a voter fires
   with its own probability: toxic texts of one language fire other voters than those of another, and the silence of
   voters that no text of a kind fires is no evidence there. Training rows with a label count for their class, all others
   by their posterior, and together at most as much as the labelled ones. Where labels gave no entries, each class is one kind, nothing
   is taken from labels, and correlations of voters within the classes discount voters that repeat each other. The patterns are at
   most 2^voters rows.
3. A logistic regression on the entries and votes is trained on the model's posterior labels of a
   bounded sample of training rows, and scores every document.

Labels, language, source and id are no inputs of a score. Training rows are those whose
crc32(doc_id as text) modulo 5 is not 0.

Nulls: a null text is an empty one; a null id counts as the empty text in the checksum and is held
out; null labels are left out. Repeated rows are scored each; of repeated labels the largest holds.
An empty table gives no rows, and without toxic training labels only the listed words count. Texts are
scored whole. Other columns of the documents are kept by `reject` and not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import lean, mapped, ranges, sampled, steps, stored, text_of, utf8

LABEL_SAMPLE = 20_000
FIT_SAMPLE = 20_000
# The entries that are kept, the strongest ones: a bound of the model's size.
ENTRIES = 256
# Clean documents that an entry is thought to be in besides those of the sample.
DOUBT = 5
LEXICONS = 12
PATTERNS = 2
VOTERS = LEXICONS + PATTERNS
PREFIXES = (3, 4, 5, 6, 7, 8)
# Words of more letters, and runs in scripts without spaces, are seen by n-grams of these lengths.
MAX_WORD = 40
LONG_GRAMS = (5,)
UNSPACED_GRAMS = (2, 3)
# Bytes of text that are worked on at a time.
STEP_BYTES = 1 << 18

# Common insults, by language; whole words.
INSULTS = """
idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb imbecile jerk filth vermin
dummkopf trottel idioten arschloch abschaum
imbécile crétin abruti connard ordure
idiota imbécil estúpido escoria basura
""".split()

# Letters of scripts that are written without spaces.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")
_LETTERS = re.compile(r"[^\W_]+")

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def held_out(id_column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def word_table(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct lower-case words of some texts, the word number of each occurrence, and the
    offsets of the texts in them."""
    data, offsets = utf8(pc.utf8_lower(texts))
    inside = _WORD_BYTE[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    edges = np.flatnonzero(edge)
    runs = inside[edges[:-1]] if len(data) else np.zeros(0, bool)
    if not runs.any():
        return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1,
                                   [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)])
    words = pieces.filter(pa.array(runs)).dictionary_encode()
    return (words.dictionary.to_pylist(), words.indices.to_numpy().astype(np.int64),
            np.searchsorted(edges[:-1][runs], offsets))


def entries_of(word: bytes) -> list[str]:
    """What a run of word bytes may match: the beginnings of its words, and each word with an end mark; of
    long or unspaced ones the n-grams at all positions, with a mark before them."""
    out: list[str] = []
    for text in _LETTERS.findall(word.decode("utf-8", "ignore")):
        lengths = UNSPACED_GRAMS if _UNSPACED.search(text) else LONG_GRAMS if len(text) > MAX_WORD else None
        if lengths is None:
            out += [text[:n] for n in PREFIXES if n <= len(text)]
            out.append(text + "$")
        else:
            out += {"~" + text[i:i + n] for n in lengths for i in range(len(text) - n + 1)}
    return out


def _per_text(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs in order."""
    if not len(rows):
        return rows, values
    key = np.unique(rows * (int(values.max()) + 1) + values)
    return key // (int(values.max()) + 1), key % (int(values.max()) + 1)


def learn_entries(sample: DataFrame, listed: list[str]) -> tuple[list[str], bool]:
    """The listed entries and those of labelled texts (text, toxic), those with the largest share of toxic texts
    first, and whether any were learned."""
    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, j - i) for b in batches for i, j in steps(utf8(b.column(0))[1], STEP_BYTES)):
            words, number, offsets = word_table(batch.column(0))
            toxic = batch.column(1).to_numpy()
            names: dict[str, int] = {}
            own = [[names.setdefault(e, len(names)) for e in entries_of(w)] for w in words]
            sizes = np.array([len(o) for o in own], np.int64)
            flat = np.array([e for o in own for e in o], np.int64)
            first = np.cumsum(sizes) - sizes
            row, word = _per_text(np.repeat(np.arange(len(toxic)), np.diff(offsets)), number)
            many = sizes[word]
            row, entry = _per_text(np.repeat(row, many), flat[ranges(first[word], many)])
            hits = np.bincount(entry, toxic[row], len(names)).astype(np.int64)
            docs = np.bincount(entry, minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(names), pa.string()), pa.array(hits), pa.array(docs)],
                                             names=["entry", "hits", "docs"])

    sample = stored(sample, "labelled")
    rows, positives = sample.agg(F.count("*"), F.sum("toxic")).first()
    if not positives or positives == rows:
        return listed, False
    counts = sample.mapInArrow(count, "entry string, hits long, docs long").groupBy("entry").agg(
        F.sum("hits").alias("hits"), F.sum("docs").alias("docs"))
    base = F.lit(positives / rows)
    hits, docs = F.col("hits").cast("double"), F.col("docs").cast("double")
    clean = docs - hits
    gain = 2 * (hits * F.log(hits / (docs * base))
                + F.when(clean > 0, clean * F.log(clean / (docs * (1 - base)))).otherwise(0.0))
    counts = stored(counts.where("hits > 1").withColumn("gain", gain).where(hits > 2 * docs * base), "labelled")
    # What is left by chance of so many tests is below this.
    tests = counts.count()
    least = 8 + 2 * float(np.log(max(2, tests)))
    best = counts.where((F.col("gain") >= least) & (hits >= 0.5 * docs)).orderBy(
        F.col("gain").desc(), F.length("entry"), "entry").limit(20 * ENTRIES).collect()
    chosen: list[str] = []
    for r in best:
        if len(chosen) < ENTRIES and not any(r[0].startswith(c) or c.startswith(r[0]) for c in chosen):
            chosen.append(r[0])
    # The listed ones that show nothing come last, in their order.
    known = {r[0]: r for r in [*best, *counts.where(F.col("entry").isin(listed)).collect()]}
    share = {e: r["hits"] / (r["docs"] + DOUBT) for e, r in known.items()}
    return sorted(listed + [e for e in chosen if e not in listed], key=lambda e: -share.get(e, 0.0)), bool(chosen)


@dataclass
class Votes:
    """Entries found in each text (row, entry pairs) and the votes as bits."""

    row: np.ndarray
    entry: np.ndarray
    votes: np.ndarray


def vote(texts: pa.Array, number_of: dict[str, int]) -> Votes:
    words, number, offsets = word_table(texts)
    own = [[number_of[e] for e in entries_of(w) if e in number_of] for w in words]
    sizes = np.array([len(o) for o in own], np.int64)
    flat = np.array([e for o in own for e in o], np.int64)
    first = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    if len(words):
        hit = sizes[number] > 0
        row, number = row[hit], number[hit]
        row, number = _per_text(row, number)
    many = sizes[number] if len(words) else np.zeros(0, np.int64)
    row, entry = _per_text(np.repeat(row, many), flat[ranges(first[number], many)] if len(many) else flat[:0])
    votes = np.zeros(len(texts), np.int64)
    np.bitwise_or.at(votes, row, np.int64(1) << (entry * LEXICONS // max(1, len(number_of))))
    # Form: many capitals, many exclamation marks.
    data, at = utf8(texts)
    size = np.maximum(1, np.diff(at))
    for i, (mark, share) in enumerate((((data >= 65) & (data <= 90), 0.3), (data == 33, 0.02))):
        sums = np.concatenate([[0], np.cumsum(mark)])
        votes |= ((sums[at[1:]] - sums[at[:-1]]) / size > share).astype(np.int64) << (LEXICONS + i)
    return Votes(row, entry, votes)


def fit_kinds(fires: np.ndarray, counts: np.ndarray, known: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The posterior probability of the toxic class for each vote pattern; `known` has the clean and the toxic rows
    among the counts. A kind of each class starts at each voter, from the rows that fire it, and one from those
    without votes."""
    free = np.maximum(counts - known.sum(axis=1), 0)
    free *= min(1.0, known.sum() / max(1.0, free.sum()))
    start = np.column_stack([fires, ~fires.any(axis=1)])
    kinds = [c[:, None] * start / start.sum(axis=1, keepdims=True) for c in known.T]
    overall = counts @ fires / counts.sum()
    posterior = np.zeros(len(counts))
    for _ in range(rounds):
        total = sum(k.sum() for k in kinds)
        joint = []
        for k in kinds:
            size = k.sum(axis=0)
            p = np.clip((k.T @ fires + overall) / (size[:, None] + 1), 1e-6, 1 - 1e-6)
            joint.append(np.log(np.maximum(size, 1e-9) / total) + fires @ np.log(p).T + (1 - fires) @ np.log(1 - p).T)
        clean, toxic = (np.logaddexp.reduce(j, axis=1) for j in joint)
        new = 1 / (1 + np.exp(-np.clip(toxic - clean, -50, 50)))
        rows = known + np.column_stack([free * (1 - new), free * new])
        kinds = [r[:, None] * np.exp(j - t[:, None]) for r, j, t in zip(rows.T, joint, (clean, toxic))]
        if np.abs(new - posterior).max() < 1e-6:
            break
        posterior = new
    return new


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200,
                    known: np.ndarray | None = None) -> np.ndarray:
    """The posterior probability of the toxic class for each vote pattern. `known` may have the labelled rows of
    each pattern, clean and toxic, which are among its count."""
    fires = (patterns[:, None] >> np.arange(VOTERS) & 1).astype(float)
    if known is not None and known.sum(axis=0).all():
        return fit_kinds(fires, counts, known, rounds)
    weight = counts / counts.sum()
    # A start on the side of the lexicons: they fire more in the toxic class.
    lexicon = np.arange(VOTERS) < LEXICONS
    overall = weight @ fires
    share = float(np.clip(weight @ (fires[:, :LEXICONS].sum(axis=1) > 0), 1e-4, 0.5))
    toxic = np.where(lexicon, np.clip(overall / share, 0.05, 0.9), np.clip(overall, 1e-3, 0.9))
    clean = np.where(lexicon, 1e-3, np.clip(overall, 1e-3, 0.9))

    def log_odds(scale: np.ndarray, prior: float) -> np.ndarray:
        on, off = np.log(toxic / clean), np.log((1 - toxic) / (1 - clean))
        return np.log(prior / (1 - prior)) + (fires * on + (1 - fires) * off) @ scale

    posterior = 1 / (1 + np.exp(-log_odds(np.ones(VOTERS), share)))
    for _ in range(rounds):
        p, q = weight * posterior, weight * (1 - posterior)
        toxic = np.clip((p @ fires + 1e-4) / (p.sum() + 2e-4), 1e-6, 1 - 1e-6)
        clean = np.clip((q @ fires + 1e-6) / (q.sum() + 1e-2), 1e-6, 1 - 1e-6)
        share = float(np.clip(p.sum(), 1e-6, 1 - 1e-6))
        new = 1 / (1 + np.exp(-np.clip(log_odds(np.ones(VOTERS), share), -50, 50)))
        if np.abs(new - posterior).max() < 1e-9:
            break
        posterior = new
    # Correlations within the classes; a voter that others repeat counts for less.
    overlap = np.zeros((VOTERS, VOTERS))
    for w, mean in ((weight * posterior, toxic), (weight * (1 - posterior), clean)):
        off = fires - mean
        cov = (off * w[:, None]).T @ off
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        overlap += w.sum() * np.clip(cov / np.outer(sd, sd), 0, 1)
    np.fill_diagonal(overlap, 0)
    scale = 1 / (1 + overlap.sum(axis=1))
    return 1 / (1 + np.exp(-np.clip(log_odds(scale, share), -50, 50)))


def fit_logistic(rows: list[np.ndarray], target: np.ndarray, size: int, ridge: float = 1e-2) -> np.ndarray:
    """Weights and, last, the bias, by Newton steps on the cross entropy with soft targets."""
    x = np.zeros((len(rows), size + 1))
    for i, r in enumerate(rows):
        x[i, r] = 1
    x[:, size] = 1
    penalty = np.full(size + 1, ridge)
    penalty[size] = 1e-6
    w = np.zeros(size + 1)
    w[size] = np.log(np.clip(target.mean(), 1e-4, 0.5) / (1 - np.clip(target.mean(), 1e-4, 0.5)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9),
                               x.T @ (p - target) + penalty * w)
        # Damped, so that separable data do not overshoot.
        w -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    """Entries by number, weights of entries and votes, bias."""

    number_of: dict[str, int]
    weights: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        parts = [self.of(vote(texts.slice(i, j - i), self.number_of), j - i)
                 for i, j in steps(utf8(texts)[1], STEP_BYTES)]
        return np.concatenate([np.zeros(0), *parts])

    def of(self, v: Votes, n: int) -> np.ndarray:
        entries = len(self.number_of)
        z = np.bincount(v.row, self.weights[v.entry], n).astype(float) if len(v.row) else np.zeros(n)
        z += (v.votes[:, None] >> np.arange(VOTERS) & 1) @ self.weights[entries:entries + VOTERS] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "toxic", label_sample: int = LABEL_SAMPLE, fit_sample: int = FIT_SAMPLE) -> Model:
    """A model from all documents and the labels of training rows. At most `label_sample` labelled
    rows choose the entries; at most `fit_sample` rows train the regression."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    known = labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).cast("long").alias("toxic")).where(
        "doc_id is not null and toxic is not null").where(~held_out("doc_id")).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    chosen = sampled(known, ["doc_id"], label_sample, "labels")
    entries, learned = learn_entries(texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic"), [w + "$" for w in INSULTS])
    number_of = {e: i for i, e in enumerate(entries)}
    spread = spark.sparkContext.broadcast(number_of)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, j - i) for b in batches for i, j in steps(utf8(b.column(1))[1], STEP_BYTES)):
            v = vote(batch.column(1), spread.value)
            offsets = np.searchsorted(v.row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.entry.astype(np.int32))),
                 pa.array(v.votes)], names=["doc_id", "entries", "votes"])

    kind = dict(texts.dtypes)["doc_id"]
    votes = stored(texts.mapInArrow(run, f"doc_id {kind}, entries array<int>, votes long"), "votes")
    # At most 2^VOTERS rows, whatever the corpus. A label has one row, so no row is counted twice.
    classes = votes.select("doc_id", "votes").join(known, "doc_id", "left")
    table = classes.groupBy("votes").agg(F.count("*"), F.count_if(F.col("toxic") <= 0), F.count_if(F.col("toxic") > 0)).collect()
    if not table:
        return Model(number_of, np.append(np.zeros(len(entries) + VOTERS), -6.0))
    patterns = np.array([r[0] for r in table])
    counts, labelled = np.array([r[1] for r in table], float), np.array([r[2:] for r in table], float)
    posterior = dict(zip(patterns.tolist(), fit_label_model(patterns, counts, known=labelled if learned else None)))
    rows = sampled(votes.where(~held_out("doc_id")), ["doc_id"], fit_sample, "fitted").collect()
    if not rows or not entries:
        return Model(number_of, np.append(np.zeros(len(entries) + VOTERS), -6.0))
    features = [np.array([*r[1], *(len(entries) + i for i in range(VOTERS) if r[2] >> i & 1)], np.int64) for r in rows]
    target = np.array([posterior[r[2]] for r in rows])
    return Model(number_of, fit_logistic(features, target, len(entries) + VOTERS))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    spread = docs.sparkSession.sparkContext.broadcast((model.number_of, model.weights))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = Model(*spread.value).scores(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    kind = dict(docs.dtypes)[id_column]
    return docs.select(F.col(id_column), held_out(id_column).alias("h"), text_of(text_column).alias("t")).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def reject(docs: DataFrame, model: Model, text_column: str = "text", most: float = 0.5) -> DataFrame:
    """The documents with a score below `most`, with all their columns."""
    spread = docs.sparkSession.sparkContext.broadcast((model.number_of, model.weights))
    place = docs.columns.index(text_column)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(Model(*spread.value).scores(batch.column(place).fill_null("")) < most))

    return mapped(docs, run)
