"""Words of whole batches of texts as 64-bit hashes, computed on the Arrow buffers with numpy.

A word's hash is a polynomial over its bytes modulo 2**64 with a random odd base and a random value
for each byte, then mixed. It comes from differences of one running sum, so that no word becomes a
Python object. Text is taken in pieces of a bounded number of bytes, cut between words, so memory
does not grow with the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
# Fixed value: bytes hashed at a time.
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the bounds of its values; a null is an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces_of(column: pa.Array, limit: int = 2 * PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each; a longer text is a range of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    first, held = 0, 0
    for row, size in enumerate(sizes):
        if row > first and held + size > limit:
            yield first, row
            first, held = row, 0
        held += size
    if len(sizes):
        yield first, len(sizes)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


@cache
def _byte_values(fold: bool) -> np.ndarray:
    values = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64)
    if fold:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    return _powers(_BASE, PIECE + 1), _powers(inverse, PIECE + 1)


@cache
def separators(kind: str) -> np.ndarray:
    """Which bytes end a word: ``space`` only, or all but ASCII ``letters`` and digits and non-ASCII."""
    out = np.zeros(256, dtype=bool)
    if kind == "space":
        out[[0x20, *range(0x09, 0x0E)]] = True
    else:
        out[:0x80] = True
        for low, high in ("az", "AZ", "09"):
            out[ord(low) : ord(high) + 1] = False
    return out


@dataclass
class Words:
    """Hashes of all words in order, the words' byte ranges, and each text's range of words."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def texts(self) -> np.ndarray:
        """The text's position for each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


def spans(raw: np.ndarray, bounds: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words of all texts."""
    inside = ~separators(kind)[raw]
    edge = np.ones(len(raw) + 1, dtype=bool)
    edge[1:-1] = ~inside[1:] | ~inside[:-1] if len(raw) else True
    edge[bounds] = True
    starts = np.flatnonzero(inside & edge[:-1])
    ends = np.flatnonzero(inside & edge[1:]) + 1
    return starts, ends


def hash_ranges(
    raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True
) -> np.ndarray:
    """Hash of each byte range, A-Z as a-z if ``fold``. Ranges are ordered by start."""
    out = np.zeros(len(starts), dtype=U64)
    values, (powers, inverse) = _byte_values(fold), _tables()
    at = 0
    while at < len(starts):
        low = int(starts[at])
        stop = int(np.searchsorted(starts, low + PIECE, "left"))
        stop = at + int(np.searchsorted(np.maximum.accumulate(ends[at:stop]), low + PIECE, "right"))
        if stop == at:
            out[at] = _hash_long(raw[low : int(ends[at])], values)
            at += 1
            continue
        high = int(ends[at:stop].max())
        sums = np.zeros(high - low + 1, dtype=U64)
        part = values[raw[low:high]]
        part *= powers[: high - low]
        np.cumsum(part, out=sums[1:])
        s = starts[at:stop] - low
        out[at:stop] = (sums[ends[at:stop] - low] - sums[s]) * inverse[s]
        at = stop
    return mix(out)


def _hash_long(word: np.ndarray, values: np.ndarray) -> np.uint64:
    """The same polynomial for a range longer than a piece, piece by piece."""
    powers, _ = _tables()
    total, scale, step = 0, 1, pow(_BASE, PIECE, 1 << 64)
    for low in range(0, len(word), PIECE):
        part = values[word[low : low + PIECE]] * powers[: len(word[low : low + PIECE])]
        total = (total + int(np.add.reduce(part)) * scale) % (1 << 64)
        scale = scale * step % (1 << 64)
    return U64(total)


def words_of(column: pa.Array, kind: str = "space") -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of a string column, with its bytes and the bounds of its texts."""
    raw, bounds = bytes_of(column)
    starts, ends = spans(raw, bounds, kind)
    hashes = hash_ranges(raw, starts, ends)
    return Words(hashes, starts, ends, np.searchsorted(starts, bounds, "left")), raw, bounds


def reduce_by_text(values: np.ndarray, bounds: np.ndarray, how: np.ufunc, empty) -> np.ndarray:
    """``how`` over each text's values; ``empty`` for a text without any."""
    out = np.full(len(bounds) - 1, empty, dtype=values.dtype)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        out[full] = how.reduceat(values, bounds[:-1][full])
    return out


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's word shingles, repeats included, and each text's range of them.

    A text with fewer words than ``size`` has one shingle, its whole sequence; one without words has
    none.
    """
    counts = words.counts()
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(bounds[-1], dtype=U64)
    factors = mix(np.arange(1, size + 1, dtype=U64) * U64(0xD6E8FEB86659FD93)) | U64(1)
    full = counts >= size
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], n) + np.repeat(words.bounds[:-1], n)
    whole = np.repeat(full, n)
    for j in range(size):
        have = whole | (np.repeat(counts, n) > j)
        where = np.flatnonzero(have)
        out[where] += words.hashes[at[where] + j] * factors[j]
    out[~whole] += np.repeat(counts, n)[~whole].astype(U64) * U64(0xA0761D6478BD642F)
    return mix(out), bounds


def sequence_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each text's whole word sequence."""
    place = np.arange(len(words.hashes)) - np.repeat(words.bounds[:-1], words.counts())
    found = []
    for salt in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3):
        weights = mix((place.astype(U64) + U64(1)) * U64(salt)) | U64(1)
        values = mix(words.hashes + U64(salt)) * weights
        total = reduce_by_text(values, words.bounds, np.add, 0)
        found.append(mix(total + words.counts().astype(U64)).view(np.int64))
    return found[0], found[1]
