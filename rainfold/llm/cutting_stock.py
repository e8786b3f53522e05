"""Cutting stock by column generation: which sizes share a bin.

A pattern is a multiset of sizes with a sum of at most ``capacity``. The linear program asks for the
fewest bins, as amounts of patterns, that hold every size as often as the histogram counts it. Its
columns are made on demand: an unbounded knapsack over the dual prices finds the pattern worth most,
and that pattern enters the basis of a revised simplex. The first basis comes from greedy filling.
The amounts are optimal when no pattern is worth more than a bin; the search also ends when the dual
bound shows that less than ``tolerance`` of the bins can be saved. The amounts are then rounded down,
patterns with the largest fractions are taken once more while their sizes are left, and what remains,
a part bounded by the number of sizes, is filled greedily.

The work depends on the number of different sizes alone, ``capacity`` at most, not on the counts.
"""

from __future__ import annotations

import numpy as np

Pattern = dict[int, int]  # size to how often


def _fill(left: dict[int, float], ordered: list[int], capacity: int) -> Pattern:
    """Largest sizes first, as many as fit and are left."""
    pattern, room = {}, capacity
    for size in ordered:
        if size <= room:
            pattern[size] = int(min(room // size, max(1, left[size])))
            room -= pattern[size] * size
    return pattern


def _first_basis(demand: dict[int, int], capacity: int) -> list[Pattern]:
    """One pattern for each size, which uses that size up: the basis is triangular."""
    left = {size: float(n) for size, n in demand.items()}
    ordered = sorted(left, reverse=True)
    patterns = []
    while ordered:
        pattern = _fill(left, ordered, capacity)
        times, last = min((left[size] / n, size) for size, n in pattern.items())
        for size, n in pattern.items():
            left[size] = max(0.0, left[size] - times * n)
        patterns.append(pattern)
        ordered.remove(last)
    return patterns


def best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, Pattern]:
    """The pattern of the highest total price: an unbounded knapsack. ``sizes`` are sorted."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        n = int(np.searchsorted(sizes, room, "right"))
        if n:
            tried = value[room - sizes[:n]] + prices[:n]
            best = int(tried.argmax())
            if tried[best] > value[room]:
                value[room], choice[room] = tried[best], best
    pattern, room = {}, capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            size = int(sizes[choice[room]])
            pattern[size] = pattern.get(size, 0) + 1
            room -= size
    return float(value[capacity]), pattern


def inverse_of(basis: np.ndarray) -> np.ndarray:
    """By elimination with elementwise steps: a threaded linear algebra library may hang in a process
    that has forked, as Spark's driver has."""
    n = len(basis)
    work = np.concatenate([basis, np.eye(n)], axis=1)
    for i in range(n):
        pivot = i + int(np.abs(work[i:, i]).argmax())
        work[[i, pivot]] = work[[pivot, i]]
        work[i] /= work[i, i]
        rest = work[:, i].copy()
        rest[i] = 0
        rows = np.flatnonzero(rest)
        work[rows] -= rest[rows, None] * work[i]
    return work[:, n:]


def solve(
    demand: dict[int, int], capacity: int, tolerance: float = 1e-3
) -> list[tuple[Pattern, float]]:
    """Patterns and how often each is taken, fractions included."""
    if not demand:
        return []
    sizes = np.array(sorted(demand))
    row = {int(size): i for i, size in enumerate(sizes)}
    # Counts that differ a little from whole numbers: no ties, in which a simplex can go in circles.
    need = np.array([demand[int(size)] for size in sizes], dtype=float)
    need += np.random.default_rng(11).uniform(1e-4, 1e-3, len(need))
    patterns = _first_basis(demand, capacity)

    def inverted() -> np.ndarray:
        basis = np.zeros((len(sizes), len(patterns)))
        for i, pattern in enumerate(patterns):
            for size, n in pattern.items():
                basis[row[size], i] = n
        return inverse_of(basis)

    inverse = inverted()
    amount = np.maximum((inverse * need).sum(axis=1), 0)
    steps = 0
    while True:
        worth, pattern = best_pattern(sizes, inverse.sum(axis=0), capacity)
        # Prices divided by ``worth`` are feasible in the dual: no mix needs fewer bins than that.
        if worth <= 1 + tolerance:
            break
        at = [row[size] for size in pattern]
        move = (inverse[:, at] * np.array(list(pattern.values()))).sum(axis=1)
        rows = np.flatnonzero(move > 1e-9)
        ratio = amount[rows] / move[rows]
        least = ratio.min()
        tied = rows[ratio <= least + 1e-12]
        out = int(tied[move[tied].argmax()])
        amount = np.maximum(amount - least * move, 0)
        amount[out] = least
        patterns[out] = pattern
        pivot = inverse[out] / move[out]
        inverse -= move[:, None] * pivot
        inverse[out] = pivot
        steps += 1
        if steps % 256 == 0:
            inverse = inverted()
            amount = np.maximum((inverse * need).sum(axis=1), 0)
    return list(zip(patterns, amount.tolist()))


def rounded(
    mix: list[tuple[Pattern, float]], demand: dict[int, int], capacity: int
) -> list[tuple[Pattern, int]]:
    """Whole numbers of patterns that hold every size exactly as often as it occurs."""
    left = dict(demand)
    taken: list[tuple[Pattern, int]] = []

    def take(pattern: Pattern, most: int) -> None:
        times = min([most, *(left[size] // n for size, n in pattern.items())])
        if times > 0:
            for size, n in pattern.items():
                left[size] -= n * times
            taken.append((pattern, times))

    for pattern, amount in mix:
        take(pattern, int(amount))
    for pattern, amount in sorted(mix, key=lambda x: -(x[1] % 1)):
        take(pattern, 1)
    ordered = sorted((size for size, n in left.items() if n), reverse=True)
    while ordered:
        take(_fill(left, ordered, capacity), max(left.values()))
        ordered = [size for size in ordered if left[size]]
    return taken
