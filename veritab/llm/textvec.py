"""Hashes of all words of a batch of texts, by numpy over the bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_random = np.random.default_rng(20240607)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: classes of bytes: 0 between words, else bytes of one class make a word
SPACED = np.ones(256, np.uint8)
SPACED[[9, 10, 11, 12, 13, 32]] = 0
PUNCTUATED = SPACED.copy()
PUNCTUATED[[*range(33, 48), *range(58, 65), *range(91, 95), 96, *range(123, 127)]] = 2
_powers = np.ones(1, np.uint64)
#: bytes of text hashed at a time
CHUNK_BYTES = 250_000


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        steps = np.full(max(n, 4096), _STEP, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def word_hashes(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (A-Z lowered) of texts ``data[offsets[i]:offsets[i + 1]]``, and words per text.

    A word is a run of bytes of one non-zero class. Its hash is a polynomial in the word's bytes modulo 2^64 over
    random byte values, mixed with its length.
    """
    n_texts = len(offsets) - 1
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(n_texts, np.int64)
    kind = classes[data]
    change = np.empty(len(data), bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change[offsets[:-1][offsets[:-1] < len(data)]] = True
    runs = np.flatnonzero(change)
    lengths = np.diff(runs, append=len(data))
    place = np.arange(len(data)) - np.repeat(runs, lengths)
    powers = _power_table(int(lengths.max()))
    sums = np.add.reduceat(_BYTE[_LOWER[data]] * powers[place], runs)
    real = kind[runs] > 0
    starts = runs[real]
    hashes = mix(sums[real] ^ (lengths[real].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return hashes, np.diff(np.searchsorted(starts, offsets)).astype(np.int64)


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last + 1, bytes, offsets) for slices of about ``CHUNK_BYTES``; a null text has no bytes."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        last = min(last, len(texts))
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last
