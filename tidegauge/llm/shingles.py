"""Hashes of word shingles, as the near-duplicate operators use them.

Empty bytes have no shingles; texts of fewer words than a shingle have one, the whole sequence.
Bytes beyond ASCII are parts of words.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np

SEED = 42

# A-Z to a-z and the other white space to the space.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz     ")


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of each run of `words` words of a text in UTF-8, joined by spaces, in lower case."""
    from xxhash import xxh64_intdigest as xxh

    parts = text.translate(_FOLD).split()
    if not parts:
        return []
    if len(parts) <= words:
        return [xxh(b" ".join(parts), SEED)]
    joined = b" ".join(parts)
    ends = list(accumulate(len(p) + 1 for p in parts))
    starts = [0, *ends]
    return [xxh(joined[s:e - 1], SEED) for s, e in zip(starts, ends[words - 1:])]


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The distinct shingle hashes in rising order."""
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))
