"""Quality of documents by a factorisation machine.

A document's features are its hashed words, each with its share of the words, its structure (shares of
letters, capitals, digits, signs, white space and other bytes, word and line lengths, repetition) and
its recorded length, both cut into steps, one feature for each step. The machine adds a weight for
each feature and, for each pair of features, the product of two low-rank vectors. By the identity
sum over pairs = (square of the sum - sum of squares) / 2, the pairs are scored in linear time.

Features are made from Arrow buffers, on the executors. The machine is fitted by adaptive gradient
steps on a bounded sample of labelled rows, whose features, not texts, come to the driver; what is
broadcast has a fixed size. The last step fits a logistic curve to the sample's scores, since a
threshold on the score presumes probabilities.

Nulls and oddities: null and empty texts have structure features only, and a score. A null recorded
length is a step of its own. Repeated rows score alike. Null labels do not count; without labels of
both kinds the score is the share of good ones, or 0.5 without any.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rainfold.llm.hashing import U64, pieces_of, reduce_by_text, words_of

# Word features (a power of two), steps of a structure figure, rank, and the figures.
WORDS = 1 << 16
STEPS = 16
RANK = 8
FIGURES = (
    "letters", "capitals", "digits", "signs", "space", "other", "word_length", "longest_word",
    "line_length", "lines", "distinct", "same_as_last", "most_common", "size", "recorded",
)
FEATURES = WORDS + len(FIGURES) * STEPS


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _step(values: np.ndarray, least: float, most: float, logarithmic: bool = False) -> np.ndarray:
    if logarithmic:
        values, least, most = np.log(np.maximum(values, least)), math.log(least), math.log(most)
    return np.clip((values - least) / (most - least) * STEPS, 0, STEPS - 1).astype(np.int64)


def features(texts: pa.Array, recorded: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers and values of all texts, and each text's range of them.

    ``recorded`` is the length that the table states, negative where it states none.
    """
    words, raw, bounds = words_of(texts)
    n, sizes = len(bounds) - 1, np.diff(bounds)
    kind = np.full(256, 3, dtype=np.uint8)  # signs
    kind[[0x20, *range(0x09, 0x0E)]] = 4
    kind[0x80:] = 5
    for low, high, k in (("a", "z", 0), ("A", "Z", 1), ("0", "9", 2)):
        kind[ord(low) : ord(high) + 1] = k
    kinds = kind[raw]
    shares = [
        _share(reduce_by_text((kinds == k).astype(np.int64), bounds, np.add, 0), sizes)
        for k in range(6)
    ]
    counts, text = words.counts(), words.texts()
    lengths = words.ends - words.starts
    lines = reduce_by_text((raw == 0x0A).astype(np.int64), bounds, np.add, 0) + 1
    same = np.zeros(len(text), dtype=np.int64)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (text[1:] == text[:-1])

    # Different words of each text and how often each occurs: equal hashes stand together.
    order = np.lexsort((words.hashes, text))
    sorted_text, sorted_hash = text[order], words.hashes[order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = (sorted_text[1:] != sorted_text[:-1]) | (sorted_hash[1:] != sorted_hash[:-1])
    at = np.flatnonzero(first)
    often = np.diff(np.append(at, len(order)))
    owner = sorted_text[at]
    distinct = np.bincount(owner, minlength=n)
    edges = np.concatenate([[0], np.cumsum(distinct)])
    most_common = reduce_by_text(often, edges, np.maximum, 0)

    steps = [
        *(_step(x, 0, 1) for x in shares),
        _step(_share(reduce_by_text(lengths, words.bounds, np.add, 0), counts), 1, 200, True),
        _step(reduce_by_text(lengths, words.bounds, np.maximum, 0), 1, 10_000, True),
        _step(_share(sizes, lines), 1, 20_000, True),
        _step(lines, 1, 10_000, True),
        _step(_share(distinct, counts), 0, 1),
        _step(_share(reduce_by_text(same, words.bounds, np.add, 0), counts), 0, 1),
        _step(_share(most_common, counts), 0, 1),
        _step(sizes, 1, 1_000_000, True),
        np.where(recorded < 0, 0, 1 + _step(recorded, 1, 1_000_000, True) * (STEPS - 1) // STEPS),
    ]
    structure = np.stack([WORDS + i * STEPS + step for i, step in enumerate(steps)], axis=1)
    numbers = np.concatenate([structure.ravel(), (sorted_hash[at] & U64(WORDS - 1)).astype(np.int64)])
    values = np.concatenate(
        [np.full(structure.size, 1 / math.sqrt(len(FIGURES))), np.sqrt(often / counts[owner])]
    ).astype(np.float32)
    owners = np.concatenate([np.repeat(np.arange(n), len(FIGURES)), owner])
    by_text = np.argsort(owners, kind="stable")
    per_text = distinct + len(FIGURES)
    return numbers[by_text], values[by_text], np.concatenate([[0], np.cumsum(per_text)])


@dataclass
class Machine:
    """bias, weights and low-rank vectors; offset and slope of the logistic curve."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    offset: float = 0.0
    slope: float = 1.0

    def raw(self, numbers: np.ndarray, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = self.bias + np.add.reduceat(self.weights[numbers] * values, bounds[:-1])
        for k in range(RANK):
            part = self.vectors[k, numbers] * values
            sums = np.add.reduceat(part, bounds[:-1])
            total = total + (sums * sums - np.add.reduceat(part * part, bounds[:-1])) / 2
        return total

    def score(self, raw: np.ndarray) -> np.ndarray:
        raw = raw.astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * raw, -30, 30)))


def _rows(docs: DataFrame) -> DataFrame:
    recorded = "cast(n_chars as bigint)" if "n_chars" in docs.columns else "-1L"
    return docs.selectExpr(
        "cast(doc_id as bigint) as doc_id", "text", f"coalesce({recorded}, -1L) as recorded"
    )


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """Packed features and label of about ``most`` labelled rows at most, the same in each run."""
    known = labels.where(f"doc_id is not null and {label} in (0, 1)").selectExpr(
        "cast(doc_id as bigint) as doc_id", f"cast({label} as int) as label"
    )
    part = min(1.0, most / max(1, known.count()))
    # Bounded, so that it can be broadcast.
    chosen = known.where(f"pmod(xxhash64(doc_id), 1048576) < {int(part * 1048576)}")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in pieces_of(batch.column("text"), 4 << 20):
                piece = batch.slice(first, last - first)
                numbers, values, bounds = features(
                    piece.column("text"), np.asarray(piece.column("recorded"))
                )
                numbers, values = numbers.astype(np.int32), values.astype(np.float16)
                cut = list(zip(bounds[:-1], bounds[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array([numbers[a:b].tobytes() for a, b in cut], pa.binary()),
                        pa.array([values[a:b].tobytes() for a, b in cut], pa.binary()),
                        piece.column("label"),
                    ],
                    names=["doc_id", "numbers", "amounts", "label"],
                )

    return _rows(docs).join(F.broadcast(chosen), "doc_id").mapInArrow(
        pack, "doc_id long, numbers binary, amounts binary, label int"
    )


def fit(docs: DataFrame, labels: DataFrame, label: str, most: int = 10_000, rounds: int = 12) -> Machine:
    """Fit on about ``most`` labelled rows at most."""
    rows = sorted(tuple(r) for r in sample(docs, labels, label, most).collect())
    machine = Machine(
        0.0,
        np.zeros(FEATURES, np.float32),
        np.random.default_rng(5).normal(0, 0.02, (RANK, FEATURES)).astype(np.float32),
    )
    if not rows:
        return machine
    y = np.array([r[3] for r in rows], dtype=np.float32)
    rate = float(y.mean())
    if rate in (0.0, 1.0):
        machine.offset, machine.slope = (30.0 if rate else -30.0), 0.0
        return machine
    numbers = [np.frombuffer(r[1], np.int32) for r in rows]
    values = [np.frombuffer(r[2], np.float16).astype(np.float32) for r in rows]
    machine.bias = math.log(rate / (1 - rate))
    # A tenth of the sample is kept from the steps: the curve is fitted on it.
    apart = np.arange(len(rows)) % 10 == 9 if len(rows) >= 500 else np.zeros(len(rows), bool)
    _descend(machine, numbers, values, y, np.flatnonzero(~apart), rounds)
    curve = np.flatnonzero(apart) if apart.any() else np.arange(len(rows))
    raw = np.concatenate([machine.raw(*_joined(numbers, values, part)) for part in _parts(curve)])
    machine.offset, machine.slope = _logistic(raw, y[curve])
    return machine


def _parts(rows: np.ndarray, size: int = 128) -> list[np.ndarray]:
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def _joined(numbers: list, values: list, rows: np.ndarray) -> tuple:
    bounds = np.concatenate([[0], np.cumsum([len(numbers[i]) for i in rows])])
    return np.concatenate([numbers[i] for i in rows]), np.concatenate([values[i] for i in rows]), bounds


def _descend(machine: Machine, numbers, values, y, rows: np.ndarray, rounds: int) -> None:
    """Steps scaled by each weight's past gradients; elementwise, without a linear algebra library."""
    rng = np.random.default_rng(3)
    seen_w = np.full(FEATURES, 1e-4, np.float32)
    seen_v = np.full((RANK, FEATURES), 1e-4, np.float32)
    for _ in range(rounds):
        for part in _parts(rng.permutation(rows)):
            n, x, bounds = _joined(numbers, values, part)
            sizes = np.diff(bounds)
            gap = 1 / (1 + np.exp(-np.clip(machine.raw(n, x, bounds), -30, 30))) - y[part]
            gap = (gap / len(part)).astype(np.float32)
            spread = np.repeat(gap, sizes) * x
            machine.bias -= 0.5 * float(gap.sum())
            used, at = np.unique(n, return_inverse=True)
            g = np.bincount(at, spread, len(used)).astype(np.float32) + 1e-6 * machine.weights[used]
            seen_w[used] += g * g
            machine.weights[used] -= 0.1 * g / np.sqrt(seen_w[used])
            for k in range(RANK):
                v = machine.vectors[k, n]
                sums = np.repeat(np.add.reduceat(v * x, bounds[:-1]), sizes)
                g = np.bincount(at, spread * (sums - v * x), len(used)).astype(np.float32)
                g += 1e-6 * machine.vectors[k, used]
                seen_v[k, used] += g * g
                machine.vectors[k, used] -= 0.05 * g / np.sqrt(seen_v[k, used])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    a, b = 0.0, 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = p * (1 - p)
        g0, g1 = (y - p).sum() - 0.1 * a, ((y - p) * x).sum() - 0.1 * (b - 1)
        h00, h01, h11 = w.sum() + 0.1, (w * x).sum(), (w * x * x).sum() + 0.1
        d = h00 * h11 - h01 * h01
        da, db = (h11 * g0 - h01 * g1) / d, (h00 * g1 - h01 * g0) / d
        step = min(1.0, 2.0 / max(abs(da), abs(db), 1e-9))
        a, b = a + step * da, max(b + step * db, 0.05)
    return float(a), float(b)


def scores(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id and score of every row. The machine, of fixed size, is broadcast."""
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = held.value
        for batch in batches:
            for first, last in pieces_of(batch.column("text"), 2 << 20):
                part = batch.slice(first, last - first)
                found = features(part.column("text"), np.asarray(part.column("recorded")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(machine.score(machine.raw(*found)))],
                    names=["doc_id", "score"],
                )

    return _rows(docs).mapInArrow(score, "doc_id long, score double")
