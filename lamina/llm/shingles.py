"""Word shingles of whole texts as 64-bit hashes, computed on Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from lamina.llm.common import TextChunk, mix64, span_hashes

SHINGLE = 4
#: A-Z to lower case; blanks and the control characters 9 to 13 divide words.
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_DIVIDES = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_PLACE = mix64(np.arange(1, 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_hashes(chunk: TextChunk) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where each row's words begin (rows + 1 entries)."""
    data = _LOWER[chunk.data]
    inside = ~_DIVIDES[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[chunk.offsets] = True
    begins = inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1]) if len(data) else inside
    ends = inside & (np.concatenate((~inside[1:], [True])) | edge[1:]) if len(data) else inside
    starts = np.flatnonzero(begins)
    hashes = span_hashes(data, starts, np.flatnonzero(ends) + 1, seed=9)
    return hashes, np.searchsorted(starts, chunk.offsets)


def shingle_sets(chunk: TextChunk, length: int = SHINGLE) -> Iterator[np.ndarray]:
    """Each row's distinct shingles, ascending. A row of fewer words has their whole
    sequence as its only one; a row without words has none."""
    w, begin = word_hashes(chunk)
    n = max(0, len(w) - length + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(length):
        runs += w[k:n + k] * _PLACE[k]
    runs = mix64(runs)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        if b - a >= length:
            yield np.unique(runs[a:b - length + 1])
        elif b > a:
            short = (w[a:b] * _PLACE[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield mix64(np.array([short ^ np.uint64(0x5555555555555555)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
