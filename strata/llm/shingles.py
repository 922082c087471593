"""Word shingles of texts as sets of 64-bit hashes, from the bytes of Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
SLICE = 1 << 20  # bytes hashed at a time
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


def _mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole number (the 64-bit finalizer of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_POWERS = np.empty(0, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 256, 2 * len(_POWERS))
        _POWERS = np.cumprod(np.full(size, _BASE, dtype=np.uint64))
    return _POWERS


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``data`` (A-Z lowered) and where they start."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint64), start
    size = end - start
    word = inside[1:-1].astype(bool)
    letters = _LOWER[data[word]] + np.uint64(1)
    first = np.cumsum(size) - size
    place = np.arange(len(letters)) - np.repeat(first, size)
    total = np.add.reduceat(letters * _powers(int(size.max()))[place], first)
    return _mix(total ^ (size.astype(np.uint64) * np.uint64(_BASE))), start


def text_words(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text, hashed in slices that end at white space."""
    if len(data) <= SLICE:
        return _word_hashes(data)[0]
    out, at = [], 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data):
            gap = np.flatnonzero(_SPACE[data[end : end + SLICE]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + SLICE, len(data))
        out.append(_word_hashes(data[at:end])[0])
        at = end
    return np.concatenate(out)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """The distinct shingles, ascending; fewer words make one shingle, no words none."""
    n = len(words)
    if not n:
        return words
    if n < WORDS:
        one = np.uint64(n)
        for w in words:
            one = _mix(np.array([one ^ w], dtype=np.uint64) * np.uint64(_BASE))[0]
        return np.array([one], dtype=np.uint64)
    total = np.zeros(n - WORDS + 1, dtype=np.uint64)
    for k in range(WORDS):
        total = (total ^ words[k : n - WORDS + 1 + k]) * np.uint64((_BASE * (2 * k + 3)) & _MASK)
        total ^= total >> np.uint64(29)
    return np.unique(_mix(total))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The set of each text; null and blank texts have an empty one. Short texts are hashed together."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, buffer = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.empty(0, np.uint8)
    doc = 0
    while doc < len(texts):
        last = max(doc + 1, int(np.searchsorted(at, at[doc] + SLICE, side="right")) - 1)
        if last == doc + 1:
            yield shingle_set(text_words(data[at[doc] : at[last]]))
        else:
            # A space after each text keeps words apart.
            sizes = np.diff(at[doc : last + 1])
            joined = np.full(int(sizes.sum()) + len(sizes), 32, dtype=np.uint8)
            begins = at[doc:last] - at[doc] + np.arange(last - doc)
            keep = np.ones(len(joined), dtype=bool)
            keep[begins + sizes] = False
            joined[keep] = data[at[doc] : at[last]]
            words, starts = _word_hashes(joined)
            cuts = np.searchsorted(starts, np.append(begins, len(joined)))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                yield shingle_set(words[a:b])
        doc = last
