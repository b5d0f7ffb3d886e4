"""Words and shingles of Arrow text columns as 64-bit hashes, many documents at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer document is a block of its own.
BLOCK = 1 << 21
BASE = 0xD6E8FEB86659FD93
WHITE = bytes([0x20, *range(0x09, 0x0E)])
#: All ASCII but letters and digits.
NO_WORD = bytes(b for b in range(128) if not chr(b).isalnum())


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64 bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and their n + 1 offsets; nulls are empty."""
    texts = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data, offsets


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Runs [first, last) of documents with at most ``size`` bytes, or of one document."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last
        first = last


class Words:
    """Cuts bytes into words at ``separators`` and hashes them, A-Z lower-cased."""

    def __init__(self, separators: bytes = WHITE):
        self.cut = np.zeros(256, bool)
        self.cut[list(separators)] = True
        lower = np.arange(256)
        lower[65:91] += 32
        self.lower = lower.astype(np.uint8)
        self.byte = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self._powers(1 << 16)

    def _powers(self, n: int) -> None:
        inverse = pow(BASE, -1, 1 << 64)
        self.power, self.inverse = (
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64))]) for b in (BASE, inverse)
        )

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words; none goes over an offset."""
        inside = ~self.cut[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
        after = np.concatenate([inside[1:], [False]]) if len(data) else inside
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return starts, ends

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            p = starts[i]
            j = max(i + 1, int(np.searchsorted(starts, p + (1 << 16))))
            q = ends[j - 1]
            if q - p >= len(self.power):
                self._powers(int(q - p))
            sums = np.zeros(q - p + 1, np.uint64)
            np.cumsum(self.byte[self.lower[data[p:q]]] * self.power[: q - p], out=sums[1:])
            s, e = starts[i:j] - p, ends[i:j] - p
            out[i:j] = mix((sums[e] - sums[s]) * self.inverse[s] + (e - s).astype(np.uint64))
            i = j
        return out

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and the n + 1 places where the documents' words start."""
        low = offsets[0]
        data, offsets = data[low : offsets[-1]], offsets - low
        starts, ends = self.spans(data, offsets)
        return self.hashes(data, starts, ends), np.searchsorted(starts, offsets)


def window_hash(words: np.ndarray, places: range | list[int]) -> np.ndarray:
    """Hash of the words at ``places`` after each position, in order."""
    span = max(places) + 1
    n = max(0, len(words) - span + 1)
    total = np.zeros(n, np.uint64)
    for t in places:
        total += words[t : t + n] * np.uint64(pow(BASE, t + 1, 1 << 64) | 1)
    return mix(total)


def shingle_sets(words: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingles of each document, one after the other, and their n + 1 offsets.

    A document of fewer words has all of them as its only shingle; one without words has none.
    """
    grams = window_hash(words, range(k))
    sets, sizes = [], np.zeros(len(places) - 1, np.int64)
    for i, (a, b) in enumerate(zip(places[:-1].tolist(), places[1:].tolist())):
        if b - a >= k:
            own = np.sort(grams[a : b - k + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            own = window_hash(words[a:b], range(b - a)) ^ np.uint64(b - a)
        else:
            continue
        sets.append(own)
        sizes[i] = len(own)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])
