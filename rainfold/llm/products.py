"""All pairs of two sets of whole-number vectors whose inner product reaches a least score.

Tiles of both sets are multiplied as matrices, in single precision where that is exact: no sum of
products exceeds the product of two norms, and whole numbers below 2^24 are exact in any order of
adding. Else it is double precision below 2^52, and integers beyond. Of a tile only the rows that reach
their least score are looked at.
"""

from __future__ import annotations

import numpy as np

# Rows and asked vectors in a tile, and a vector's pairs in a tile from which on it is
# left to the caller.
SEGMENT, CHUNK = 1024, 1024
MANY = 64
LOWEST = np.iinfo(np.int64).min + 1
_SINGLE, _DOUBLE = 2.0**24, 2.0**52


def smallest(vectors: np.ndarray) -> np.ndarray:
    """The same whole numbers in two, four or eight bytes."""
    most = max(abs(int(vectors.min(initial=0))), abs(int(vectors.max(initial=0))))
    return vectors.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64)


def norms_of(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(float)
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


class Vectors:
    """Whole-number vectors with their norms, in the types that are asked for."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.norms = norms_of(vectors)
        self._as: dict = {}

    def __len__(self) -> int:
        return len(self.vectors)

    def as_type(self, kind: type) -> np.ndarray:
        if kind not in self._as:
            self._as[kind] = np.ascontiguousarray(self.vectors, kind)
        return self._as[kind]


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """The fastest type in which all products of vectors with these norms are exact."""
    most = a.max(initial=0) * b.max(initial=0)
    return np.float32 if most < _SINGLE else np.float64 if most < _DOUBLE else np.int64


def scores_of(a: np.ndarray, b: np.ndarray, kind: type, out: np.ndarray | None = None) -> np.ndarray:
    """The products of each row of ``a`` with each of ``b``, which are of this type."""
    if kind is np.int64:
        return np.einsum("ik,jk->ij", a, b)
    return np.matmul(a, b.T, out=out)


def _bar(least: np.ndarray, kind: type) -> np.ndarray:
    """Least scores in this type; those out of its reach stay out of reach."""
    if kind is np.int64:
        return least
    room = _SINGLE if kind is np.float32 else _DOUBLE
    return np.clip(least, -room, room).astype(kind)


class Search:
    """Pairs of the asked vectors with rows that come in blocks."""

    def __init__(self, asked: Vectors):
        self.asked = asked
        # Held from tile to tile, since fresh memory costs much beside the product.
        self._tile = np.empty(CHUNK * SEGMENT, np.float32)

    def reaching(
        self, which: np.ndarray, least: np.ndarray, rows: Vectors, most: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Asked vector, row and score of the pairs that reach ``least``, and the asked vectors with
        too many of them, whose pairs are left out.

        ``which`` are a chunk's asked vectors, ``least`` their whole numbers; scores over ``most``, if
        given, do not count.
        """
        kind = exact_type(self.asked.norms[which], rows.norms)
        asked, bar = self.asked.as_type(kind)[which], _bar(least, kind)
        found = [(np.zeros(0, np.int64),) * 3]
        many = [np.zeros(0, np.int64)]
        for at in range(0, len(rows), SEGMENT):
            part = rows.as_type(kind)[at : at + SEGMENT]
            shape, out = (len(asked), len(part)), None
            if kind is np.float32:
                out = self._tile[: shape[0] * shape[1]].reshape(shape)
            scores = scores_of(asked, part, kind, out)
            rise = np.flatnonzero(scores.max(axis=1) >= bar)
            reach = scores[rise] >= bar[rise, None]
            if most is not None:
                reach &= scores[rise] <= _bar(most, kind)[rise, None]
            few = reach.sum(axis=1) <= MANY
            i, x = np.divmod(np.flatnonzero(reach[few]), len(part))
            i = rise[few][i]
            found.append((i, x + at, scores[i, x].astype(np.int64)))
            many.append(rise[~few])
        i, x, score = (np.concatenate(column) for column in zip(*found))
        much = np.unique(np.concatenate(many))
        if len(much):
            keep = ~np.isin(i, much)
            i, x, score = i[keep], x[keep], score[keep]
        return which[i], x, score, which[much]


class Best:
    """The best ``k`` rows of each asked vector so far: by score, then by id."""

    def __init__(self, least: np.ndarray, k: int):
        self.k = k
        self.least = least.copy()
        self.scores = np.full((len(least), k), LOWEST)
        self.ids = np.full((len(least), k), np.iinfo(np.int64).max)

    def add(self, asked: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(asked):
            return
        held, at = np.unique(asked, return_inverse=True)
        groups = np.concatenate([np.repeat(np.arange(len(held)), self.k), at])
        scores = np.concatenate([self.scores[held].ravel(), scores])
        ids = np.concatenate([self.ids[held].ravel(), ids])
        order = np.lexsort((ids, -scores, groups))
        first = np.searchsorted(groups[order], np.arange(len(held)))
        top = order[first[:, None] + np.arange(self.k)]
        self.scores[held], self.ids[held] = scores[top], ids[top]
        self.least[held] = np.maximum(self.least[held], self.scores[held, -1])

    def needed(self, asked: np.ndarray, lowest_id: int) -> np.ndarray:
        """What a row must score to come in, if no id is below ``lowest_id``."""
        full = (self.scores[asked, -1] == self.least[asked]) & (self.least[asked] > LOWEST)
        return self.least[asked] + (full & (self.ids[asked, -1] <= lowest_id))
