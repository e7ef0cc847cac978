"""Hashed subword embeddings: features in numpy, training by stochastic gradient
descent, and scoring of whole texts.

A text is the mean of the vectors of its features (character n-grams inside
tokens with their boundaries, and whole tokens), each hashed to one of
``2**bits`` rows of an embedding table; a linear layer and a softmax follow.
Since the layer is linear, a class's logit is the mean of ``E[id] @ W``: scoring
gathers one small row per feature from that folded table, which has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

#: Code points handled at a time; a longer text goes in several slices cut between tokens.
SLICE = 1 << 18
MIX = np.uint32(0x9E3779B1)
STEP = np.uint32(0x01000193)
SPACE = 32
REPEAT = 1  # the bucket of a repeated token


@dataclass(frozen=True)
class Features:
    """Which features a text has.

    ``letters``: only letters count, in lower case, and everything else parts
    tokens; otherwise white space parts tokens and case is kept.
    """

    ngrams: tuple[int, ...] = (2, 3, 4)
    words: bool = True
    letters: bool = False
    bits: int = 18
    #: A token equal to the one before it also gives one feature common to all such tokens.
    repeats: bool = False


_TABLES: dict[bool, np.ndarray] = {}


def _char_table(letters: bool) -> np.ndarray:
    """What each code point of the basic plane becomes: 32 parts tokens."""
    if letters in _TABLES:
        return _TABLES[letters]
    out = np.full(0x10000, SPACE, np.uint32)
    for c in range(0x10000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if letters:
            if ch.isalpha():
                low = ch.lower()
                out[c] = ord(low) if len(low) == 1 else c
        elif not ch.isspace():
            out[c] = c
    _TABLES[letters] = out
    return out


def _codes(text: str, letters: bool) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _char_table(letters)
    if len(raw) and raw.max() >= 0x10000:
        low = raw < 0x10000
        out = raw.copy()
        out[low] = table[raw[low]]
        if letters:
            for c in np.unique(raw[~low]):
                ch = chr(c)
                out[raw == c] = (ord(ch.lower()) if len(ch.lower()) == 1 else c) if ch.isalpha() else SPACE
        return out
    return table[raw]


def _slices(texts: Sequence[str | None], letters: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points with a space before each text and after the last, and the text of each position."""
    parts: list[np.ndarray] = []
    owner: list[tuple[int, int]] = []
    size = 0
    gap = np.array([SPACE], np.uint32)

    def flush():
        codes = np.concatenate([*parts, gap])
        own = np.repeat([o for o, _ in owner], [n for _, n in owner])
        return codes, np.append(own, own[-1])

    for i, text in enumerate(texts):
        if not text:
            continue
        codes, at = _codes(text, letters), 0
        while at < len(codes):
            end = min(len(codes), at + SLICE)
            if end < len(codes):  # cut between tokens; a token longer than a slice stays whole
                back = np.flatnonzero(codes[at:end] == SPACE)
                ahead = None if len(back) else np.flatnonzero(codes[end:] == SPACE)
                end = at + int(back[-1]) + 1 if len(back) else end + int(ahead[0]) if len(ahead) else len(codes)
            piece = codes[at:end]
            if parts and size + len(piece) > SLICE:
                yield flush()
                parts, owner, size = [], [], 0
            parts += [gap, piece]
            owner.append((i, len(piece) + 1))
            size += len(piece) + 1
            at = end
    if parts:
        yield flush()


def feature_ids(texts: Sequence[str | None], spec: Features) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text index, bucket) arrays of every feature of every text, in slices; indices ascend."""
    shift = np.uint32(32 - spec.bits)
    for codes, own in _slices(texts, spec.letters):
        gap = codes == SPACE
        inner = ~gap
        run = codes * MIX
        run ^= run >> np.uint32(15)
        own_out, ids_out = [], []
        h = run.copy()
        interior = np.ones(len(codes), bool)  # positions 1..n-2 of the window are inside a token
        for n in range(2, max(spec.ngrams, default=1) + 1):
            m = len(codes) - n + 1
            if m <= 0:
                break
            if n > 2:
                interior = interior[:m] & inner[n - 2 : n - 2 + m]
            h = h[:m] * STEP + run[n - 1 : n - 1 + m]
            if n in spec.ngrams:
                ok = interior[:m] & (inner[:m] | inner[n - 1 : n - 1 + m]) if n == 2 else interior[:m]
                at = np.flatnonzero(ok)
                # a gap before a text counts to it: ask a place inside the token
                own_out.append(own[np.where(inner[at], at, at + 1)])
                ids_out.append(((h[at] ^ np.uint32(n)) * MIX) >> shift)
        if spec.words:
            begins = np.flatnonzero(gap[:-1] & inner[1:]) + 1
            ends = np.flatnonzero(inner[:-1] & gap[1:]) + 1
            if len(begins):
                words = word_hashes(run, begins, ends)
                ids_out.append(words >> np.uint64(64 - spec.bits))
                own_out.append(own[begins])
                if spec.repeats:
                    same = np.flatnonzero((words[1:] == words[:-1]) & (own[begins[1:]] == own[begins[:-1]])) + 1
                    ids_out.append(np.full(len(same), REPEAT))
                    own_out.append(own[begins[same]])
        yield np.concatenate(own_out) if own_out else np.empty(0, np.int64), np.concatenate([x.astype(np.int64) for x in ids_out]) if ids_out else np.empty(0, np.int64)


def word_hashes(run: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each token ``run[begin:end]``, summing it with a power per place."""
    places = np.arange(len(run), dtype=np.uint64)
    # the place inside the token, so that equal tokens hash equally anywhere
    first = np.zeros(len(run), np.uint64)
    first[begins] = begins.astype(np.uint64)
    first = np.maximum.accumulate(first)
    x = (run.astype(np.uint64) + np.uint64(1)) * (np.uint64(2) * (places - first) + np.uint64(0x632BE59BD9B4E019))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    total = np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)])
    out = (total[ends] - total[begins]) * np.uint64(0x94D049BB133111EB)
    return (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)


def bags(texts: Sequence[str | None], spec: Features) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct buckets and their shares of all its features.

    A text is reduced as soon as its last feature is there, so raw features of one slice
    (and of one text that goes on in the next) are held at a time.
    """
    done = [(np.empty(0, np.int32), np.empty(0, np.float32))] * len(texts)
    at, parts = -1, []

    def close():
        if parts:
            ids, n = np.unique(np.concatenate(parts), return_counts=True)
            done[at] = ids.astype(np.int32), (n / n.sum()).astype(np.float32)

    for own, ids in feature_ids(texts, spec):
        order = np.argsort(own, kind="stable")
        own, ids = own[order], ids[order]
        cuts = np.flatnonzero(np.diff(own)) + 1
        for i, part in zip(own[np.r_[0, cuts]].tolist() if len(own) else [], np.split(ids, cuts)):
            if i != at:
                close()
                at, parts = i, []
            parts.append(part.astype(np.int32))
    close()
    return done


def train(rows: Sequence[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, n_classes: int, spec: Features, dim: int = 16, epochs: int = 5, rate: float = 0.5, seed: int = 7) -> np.ndarray:
    """Embeddings and output layer by stochastic gradient descent, one text a step with a
    rate falling to zero; returns the folded table ``E @ W`` (buckets x classes)."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / dim, 1 / dim, (1 << spec.bits, dim)).astype(np.float32)
    out = np.zeros((dim, n_classes), np.float32)
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids, share = rows[i]
            lr = rate * (1 - done / steps)
            done += 1
            if not len(ids):
                continue
            vectors = emb[ids]
            hidden = share @ vectors
            z = hidden @ out
            p = np.exp(z - z.max())
            p /= p.sum()
            p[classes[i]] -= 1
            back = out @ p
            out -= lr * np.outer(hidden, p)
            # the share of a feature is of the order of one in the number of features:
            # its step is taken per feature, as if each had been seen alone
            emb[ids] = vectors - (lr * min(len(ids), 64)) * share[:, None] * back
    return emb @ out


def logits(texts: Sequence[str | None], table: np.ndarray, spec: Features) -> np.ndarray:
    """Mean of the folded table over each whole text's features; 0 for a text without any."""
    total = np.zeros((len(texts), table.shape[1]))
    count = np.zeros(len(texts))
    for own, ids in feature_ids(texts, spec):
        count += np.bincount(own, minlength=len(texts))
        for k in range(table.shape[1]):
            total[:, k] += np.bincount(own, weights=table[:, k][ids], minlength=len(texts))
    return total / np.maximum(count, 1)[:, None]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)
