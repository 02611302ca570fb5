"""Words of whole texts as 64-bit hashes, by array operations over the bytes of a batch.

A word is a run of bytes that are neither the space nor one of 0x09 to 0x0D; A-Z count as a-z, other letters stay.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes that are widened to 64-bit values at a time; a longer word is a piece of its own.
PIECE_BYTES = 1 << 16
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    values[ord("A"):ord("Z") + 1] = values[ord("a"):ord("z") + 1]
    return values


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span [start, end) of 64-bit values; equal contents have equal hashes wherever they stand.

    The spans are in order and do not overlap. Each value is mixed with its place in the span before the sum, so periodic texts do
    not cancel out; two different spans have one hash with a probability of about 2**-64.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    begins = np.zeros(len(values), dtype=np.int64)
    begins[starts] = starts
    place = np.arange(len(values), dtype=np.int64) - np.maximum.accumulate(begins)
    sums = np.empty(len(values) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(mix(values + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE)), out=sums[1:])
    return mix(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the offset of each text, with the end; a null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes, and the number of words before each text, with the end."""
    inside = ~SEPARATOR[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and the number of words before each text, with the end. Bytes are hashed in pieces of whole words."""
    data, offsets = text_bytes(texts)
    starts, ends, counts = word_spans(data, offsets)
    hashes, at = np.empty(len(starts), dtype=np.uint64), 0
    while at < len(starts):
        first = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, first + PIECE_BYTES, "right")))
        hashes[at:to] = span_hashes(_byte_values()[data[first:ends[to - 1]]], starts[at:to] - first, ends[at:to] - first)
        at = to
    return hashes, counts


@functools.cache
def _weights(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of each k words in a row, over the borders of texts too."""
    if len(words) < k:
        return np.zeros(0, dtype=np.uint64)
    n, weights = len(words) - k + 1, _weights(k)
    total = words[:n] * weights[0]
    for at in range(1, k):
        total += words[at:at + n] * weights[at]
    return mix(total + np.uint64(k))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; a text of fewer words is one shingle, a text without words has none."""
    words, counts = word_hashes(texts)
    grams, empty = gram_hashes(words, k), np.zeros(0, dtype=np.uint64)
    sets = []
    for a, b in zip(counts[:-1].tolist(), counts[1:].tolist(), strict=True):
        if b - a >= k:
            sets.append(np.unique(grams[a:b - k + 1]))
        else:
            sets.append(gram_hashes(words[a:b], b - a) if b > a else empty)
    return sets
