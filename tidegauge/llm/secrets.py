"""Secret scans with an incremental ledger of blobs.

Texts are content-addressed: a blob is the SHA-256 of a text, and rows are paths of blobs. The
ledger holds the findings of every (blob, rule version) scanned so far; only unseen pairs are
scanned, and findings are joined back to every path of a blob. A new rule version scans again
under its own name and leaves the earlier findings in place.

Nulls: a null text is the empty blob; null ids stay. Repeated rows each get the blob's findings.
An empty table gives no rows. Texts are scanned whole. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import ledger
from tidegauge.llm.tables import lean

# Kind, pattern, group whose length counts, least length, RE2 pattern that every
# text with a finding matches. The first three kinds are the base rules.
RULES = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
     r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}"""),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, r"AKIA[A-Z0-9]{14}"),
    ("hex", r"[0-9a-f]+", 0, 16, r"[0-9a-f]{16}"),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40, r"gh[pousr]_[A-Za-z0-9]{36}"),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15, r"xox[abprs]-[A-Za-z0-9-]{10}"),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30, r"eyJ[A-Za-z0-9_-]+\.eyJ"),
]
BASE_KINDS = 3
RULE_VERSION = hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]

_SCHEMA = "_digest string, findings array<struct<start: long, kind: int, stop: long>>"
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64())]))


def find(text: str, kinds: list[int]) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points by start, then kind; matches of a kind do not overlap."""
    out = []
    for kind in kinds:
        _, pattern, group, least, _ = RULES[kind]
        for m in re.finditer(pattern, text, re.ASCII):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def scan(texts: DataFrame) -> DataFrame:
    """Findings of each (_digest, text). A linear prefilter leaves the texts a rule may match."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(1)
            kinds: dict[int, list[int]] = {}
            for kind, rule in enumerate(RULES):
                for i in pc.indices_nonzero(pc.match_substring_regex(text, rule[4])).to_pylist():
                    kinds.setdefault(i, []).append(kind)
            found = [[] for _ in range(len(text))]
            for i, own in kinds.items():
                found[i] = [{"start": s, "kind": k, "stop": e} for s, k, e in find(text[i].as_py(), own)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _ARROW)],
                                             names=["_digest", "findings"])

    return texts.select("_digest", "text").mapInArrow(run, _SCHEMA)


def scan_paths(versions: DataFrame, store: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, blob and findings (start, kind number, stop) of every row; scans what the ledger
    in the folder `store` lacks and appends it."""
    rows = versions.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    keyed, findings = ledger.resolve(rows, store, RULE_VERSION, _SCHEMA, scan)
    return keyed.join(findings, "_digest").select("doc_id", F.col("_digest").alias("blob"), "findings")


def spans(findings, base: bool):
    """Findings as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(r[0]) for r in RULES])
    if base:
        findings = F.filter(findings, lambda f: f["kind"] < BASE_KINDS)
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(
        ":", F.get(names, f["kind"]), f["start"].cast("string"), f["stop"].cast("string"))), ",")
