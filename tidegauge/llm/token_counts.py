"""Token counts with a digest cache.

A count depends on the text and the tokenizer only, so counts are stored by the digest of the
text under the tokenizer's version (the digest of its file). Texts whose digest is stored are
not encoded again, and of equal texts one is encoded. The byte-level vocabularies have no
normaliser, so a text normalises to itself (null to the empty text).

Nulls: a null text has 0 bytes and 0 tokens; null ids stay. Repeated rows each get their count.
An empty table gives no rows. Only the id and the text are read, so other columns' names do not
matter; very long texts are encoded whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import ledger
from tidegauge.llm.encoding import encoder
from tidegauge.llm.tables import lean, text_of

_SCHEMA = "_digest string, n_tokens long"


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def encode_counts(texts: DataFrame, tokenizer: str) -> DataFrame:
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(tokenizer) as own:
            for batch in batches:
                for i, j, _, offsets in own.steps(batch.column(1)):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(offsets))],
                                                     names=["_digest", "n_tokens"])

    return texts.select("_digest", "text").mapInArrow(run, _SCHEMA)


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int = 512, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row. `cache` is a folder that all
    executors can reach; it grows by the texts not counted before."""
    text = text_of(text_column)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       text.alias("text"))
    keyed, counts = ledger.resolve(rows, cache, tokenizer_version(tokenizer), _SCHEMA,
                                   lambda missing: encode_counts(missing, tokenizer))
    return keyed.join(counts, "_digest").select("doc_id", "n_bytes", "n_tokens",
                                                (F.col("n_tokens") > limit).alias("over_limit"))
