"""Token ids of whole texts by the tokenizers library, each distinct word encoded once.

Prose repeats its words, so a batch of texts is cut into pieces, the distinct pieces are
encoded, and the ids of the texts are put together with numpy. Pieces are cut only where
the pre-tokenizers of these vocabularies always cut as well:

* before a space that a visible character follows,
* between an ASCII letter and another ASCII character that is none,
* between a line feed that follows a printed ASCII character and an ASCII letter.

A text with one of the added tokens (or part of it: the marker below) is one piece, and so is
every text of a tokenizer whose pre-tokenizer is another one. The ids are those of
`Tokenizer.encode(text, add_special_tokens=False)` in all cases.
"""

from __future__ import annotations

import itertools
import json
import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidegauge.llm.tables import ranges, steps, utf8

# Pieces that a Python worker remembers, about 200 bytes each.
CACHED_PIECES = 500_000
# Bytes of text that are worked on at a time, and pieces encoded in one call.
STEP_BYTES = 1 << 21
CALL_PIECES = 10_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_OTHER_ASCII = ~_LETTER & (np.arange(256) < 128)
# Bytes that may begin a visible character; the last four lead bytes may begin white space.
_VISIBLE = np.ones(256, bool)
_VISIBLE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0xC2, 0xE1, 0xE2, 0xE3]] = False

_PRINTED = (np.arange(256) > 32) & (np.arange(256) < 127)

# The names that byte-level vocabularies give to bytes. Printed ones are their own.
_OWN_NAME = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_NAMES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _OWN_NAME)}

# The two pre-tokenizer forms for which the cuts above are exact.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def vocabulary_size(path: str) -> int:
    """Ids of a tokenizer file run from 0 to this number, exclusive."""
    from tokenizers import Tokenizer

    return 1 + max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())


def _cuts_are_exact(normalizer: dict | None, pre: dict | None) -> bool:
    steps = normalizer.get("normalizers", [normalizer]) if normalizer else []
    if any(s["type"] not in ("NFC", "Lowercase") and s.get("pattern") != {"Regex": r"\s+"} for s in steps):
        return False
    pre = pre or {}
    if pre.get("type") == "ByteLevel":
        return pre.get("use_regex") is True and pre.get("add_prefix_space") is False and not steps
    parts = pre.get("pretokenizers", [])
    return (len(parts) == 2 and parts[0].get("pattern") == {"Regex": _WORD_PATTERN} and parts[0].get("invert") is True
            and parts[1].get("type") == "ByteLevel" and parts[1].get("use_regex") is False)


class Encoder:
    """Encodes string columns; lent to tasks by `encoder`."""

    def __init__(self, path: str):
        # One thread: Spark runs a worker per core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The parts' own descriptions; the file itself would fill a worker's memory when parsed.
        normalizer, pre = (p and json.loads(p.__getstate__()) for p in (
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer))
        self.exact = _cuts_are_exact(normalizer, pre)
        self.lower = normalizer is not None
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 18, np.uint32)
        self.starts, self.counts = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.used = 0

    def _learn(self, pieces: list[bytes]) -> None:
        for i in range(0, len(pieces), CALL_PIECES):
            self._add(pieces[i:i + CALL_PIECES])

    def _word(self, piece: bytes) -> str | None:
        """The form in which the model takes a piece that is one word of Latin-1 letters, which
        the pre-tokenizer would leave whole; None for any other piece."""
        word = piece[1:] if piece[:1] == b" " else piece
        if word.isalpha():
            text = word.decode("ascii")
        else:
            text = word.decode()
            if not text.isalpha() or max(text) > "\xff":
                return None
        if self.lower:
            return text.lower().encode().decode("latin-1").translate(_BYTE_NAMES)
        return ("\u0120" if piece[:1] == b" " else "") + word.decode("latin-1").translate(_BYTE_NAMES)

    def _add(self, pieces: list[bytes]) -> None:
        words = [self._word(p) for p in pieces] if self.exact else [None] * len(pieces)
        tokenize = self.tokenizer.model.tokenize
        ids = [None if w is None else [t.id for t in tokenize(w)] for w in words]
        rest = [i for i, w in enumerate(words) if w is None]
        done = self.tokenizer.encode_batch_fast([pieces[i].decode() for i in rest], add_special_tokens=False)
        for i, e in zip(rest, done):
            ids[i] = e.ids
        n, at = len(ids), len(self.known)
        counts = np.fromiter(map(len, ids), np.int64, n)
        total = int(counts.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        if at + n > len(self.starts):
            more = np.zeros(len(self.starts) + n, np.int64)
            self.starts, self.counts = np.concatenate([self.starts, more]), np.concatenate([self.counts, more])
        self.ids[self.used:self.used + total] = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, total)
        self.starts[at:at + n] = self.used + np.cumsum(counts) - counts
        self.counts[at:at + n] = counts
        self.used += total
        self.known.update(zip(pieces, range(at, at + n)))

    def _cuts(self, texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(data) + 1, bool)
        if self.exact and len(data):
            letter = _LETTER[data]
            cut[1:-1] = letter[:-1] & _OTHER_ASCII[data[1:]]
            cut[2:-1] |= letter[2:] & (data[1:-1] == 10) & _PRINTED[data[:-2]]
            cut[:-2] |= (data[:-1] == 32) & _VISIBLE[data[1:]]
            for marker in {a[:2] for a in self.added}:
                for i in np.flatnonzero(pc.match_substring(texts, marker).to_numpy(zero_copy_only=False)):
                    cut[offsets[i]:offsets[i + 1]] = False
        cut[offsets] = True
        return np.flatnonzero(cut)

    def steps(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row, ids, offsets) of slices with about STEP_BYTES bytes."""
        for i, j in steps(utf8(texts)[1], STEP_BYTES):
            yield i, j, *self.encode(texts.slice(i, j - i))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column without nulls, and the offsets of its rows in them."""
        data, offsets = utf8(texts)
        cuts = self._cuts(texts, data, offsets)
        if len(cuts) < 2:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1,
                                       [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        missing = [p for p in distinct if p not in self.known]
        if len(self.known) + len(missing) > CACHED_PIECES:
            self.forget()
            missing = distinct
        self._learn(missing)
        known = self.known
        number = np.fromiter((known[p] for p in distinct), np.int64, len(distinct))
        each = number[coded.indices.to_numpy()]
        counts = self.counts[each]
        ids = self.ids[ranges(self.starts[each], counts)]
        before = np.concatenate([[0], np.cumsum(counts)])
        return ids, before[np.searchsorted(cuts, offsets)]


@contextmanager
def encoder(path: str, keep: bool = False) -> Iterator[Encoder]:
    """An encoder for one task. The tokenizer stays with the Python worker, which outlives its
    tasks; the pieces are forgotten, so that an idle worker holds little memory, unless they are
    to be kept for the next task (at most about 100 MB). (Functions are
    sent to workers by value, so what is kept lives with the imported library.)"""
    import tokenizers

    kept = vars(tokenizers).setdefault("_encoders_of_this_worker", {})
    if path not in kept:
        kept[path] = Encoder(path)
    try:
        yield kept[path]
    finally:
        if not keep:
            kept[path].forget()
