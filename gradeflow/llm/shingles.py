"""Word shingle sets in numpy, from the bytes of an Arrow string column.

A word is a run of bytes other than white space (0x20, 0x09 to 0x0D), with A to Z
in lower case; a shingle is five words in a row, or all words of a shorter text.
Shingles are held as 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORDS = 5
#: Bytes handled at a time; a longer text is one slice of its own.
SLICE = 1 << 20
_RNG = np.random.default_rng(20)
BYTE = _RNG.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
BYTE[65:91] = BYTE[97:123]
PLACE = np.uint64(0x9E3779B97F4A7C15)
TERM = _RNG.integers(1, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a byte array."""
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    inner = ~gap
    edge = np.diff(np.concatenate([[0], inner.view(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begins):
        return begins, np.empty(0, np.uint64)
    lengths = ends - begins
    # each byte, mixed with its place in its word, is summed over the word
    at = np.arange(len(raw), dtype=np.uint64)
    first = np.zeros(len(raw), np.uint64)
    first[begins] = begins.astype(np.uint64)
    at -= np.maximum.accumulate(first)
    x = mixed(BYTE[raw] + at * PLACE)
    x[gap] = 0
    total = np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)])
    return begins, mixed((total[ends] - total[begins]) ^ (lengths.astype(np.uint64) << np.uint64(40)))


def _shingles(words: np.ndarray) -> np.ndarray:
    n = len(words)
    if not n:
        return words
    k = min(n, WORDS)
    out = np.full(n - k + 1, np.uint64(k))
    for j in range(k):
        out += words[j : n - k + 1 + j] * TERM[j]
    return np.unique(mixed(out))


def shingle_sets(texts: pa.StringArray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; empty without a word or text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    n = len(texts)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    valid = texts.is_valid().to_numpy(zero_copy_only=False)
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * n
    i = 0
    while i < n:
        j = i + 1
        while j < n and offsets[j + 1] - offsets[i] <= SLICE:
            j += 1
        lo, hi = int(offsets[i]), int(offsets[j])
        # a gap between texts, so that no word spans two of them
        lengths = np.diff(offsets[i : j + 1])
        shift = np.arange(j - i)
        padded = np.full(hi - lo + (j - i), 32, np.uint8)
        padded[np.arange(hi - lo) + np.repeat(shift, lengths)] = raw[lo:hi]
        begins, words = _word_hashes(padded)
        cuts = np.searchsorted(begins, offsets[i : j + 1] - lo + np.arange(j - i + 1))
        for d in range(i, j):
            if valid[d]:
                out[d] = _shingles(words[cuts[d - i] : cuts[d - i + 1]])
        i = j
    return out
