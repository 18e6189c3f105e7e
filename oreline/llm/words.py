"""Hashes of words and shingles for a batch of texts, without a Python object per word.

The bytes of an Arrow string column are read in place. A word's hash is a polynomial over its bytes
modulo 2^64, taken as a difference of running sums and then mixed; equal words have equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
#: Texts are taken in runs of about so many bytes, which bounds the working memory; a longer text is a run.
RUN_BYTES = 1 << 18

def _classes(ends_word) -> bytes:
    """What each byte counts as: 0 ends a word, A-Z are a-z, NUL is FF, which UTF-8 never has."""
    return bytes(0 if ends_word(b) else ord(chr(b).lower()) if 0x41 <= b <= 0x5A else b or 0xFF for b in range(256))


#: Words between ASCII white space, and words of letters and digits (any byte that is not ASCII counts as a letter).
SPACED = _classes(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
LETTERS = _classes(lambda b: b < 128 and not chr(b).isalnum())

_powers = {b: np.ones(1, np.uint64) for b in (_BASE, _INVERSE)}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        size = max(n, RUN_BYTES + 1)
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        _powers[base] = np.multiply.accumulate(factors)
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def scan(texts: pa.Array, classes: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (first text, bounds, bytes, begin, word hashes) of runs of texts.

    Text first + i is bytes[bounds[i]:bounds[i + 1]]; each word begins at its ``begin``. A null text has no words.
    """
    offsets, data = _buffers(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = first + 1
        while last < n and offsets[last + 1] - offsets[first] <= RUN_BYTES:
            last += 1
        bounds = offsets[first : last + 1] - offsets[first]
        own = data[offsets[first] : offsets[last]]
        kinds = np.frombuffer(own.tobytes().translate(classes), np.uint8)
        size = len(kinds)
        # edge[i]: whether byte i and the one before differ in being part of a word; texts break words as well.
        solid = np.zeros(size + 2, bool)
        np.not_equal(kinds, 0, out=solid[1:-1])
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        begin, stop = edges[::2], edges[1::2]
        cuts = bounds[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < size)]
        inside = np.unique(cuts[solid[cuts] & solid[cuts + 1]])
        if len(inside):
            begin, stop = np.sort(np.append(begin, inside)), np.sort(np.append(stop, inside))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(kinds * _power(_BASE, size), out=sums[1:])
        hashes = mix((sums[stop] - sums[begin]) * _power(_INVERSE, size + 1)[begin])
        yield first, bounds, own, begin, hashes
        first = last


def runs(texts: pa.Array, classes: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first text, word hashes, limits): words of text first + i are hashes[limits[i]:limits[i + 1]]."""
    for first, bounds, _, begin, hashes in scan(texts, classes):
        yield first, hashes, np.searchsorted(begin, bounds)


_STEPS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``width`` consecutive words; fewer words are one shingle, none are none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    take = min(width, len(words))
    steps = mix(np.arange(1, take + 1, dtype=np.uint64)) | np.uint64(1) if take > len(_STEPS) else _STEPS[:take]
    rows = len(words) - take + 1
    total = np.full(rows, take, np.uint64)
    for i in range(take):
        total += words[i : i + rows] * steps[i]
    return np.unique(mix(total))
