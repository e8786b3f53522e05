"""Toxicity of documents after noisy-channel deobfuscation.

Words may be hidden by look-alike characters (``1d10t``), spacing (``i d i o t``) and repetition
(``idiooot``). A text's spans that show such signs become character lattices: each written character
may stand for itself or for a letter that it resembles, a run of three or more may stand for one or
two, a sign between single letters for nothing. A Viterbi search finds the most likely reading under a character
trigram model, counted over all documents, and a channel model. All other words have one reading.

The restored words are scored by a multinomial model over word types. A word's type is the whole word
or one of its stems, if a test over the labelled documents ties that to a label, else "other"; the
longest such type counts. The sum of log ratios goes through a logistic curve fitted to the same
labelled rows' histogram of sums. Counting is one pass over the labelled rows: each task adds up its
types before the shuffle, and only types that pass the test, a bounded number, reach the driver.

Nulls and oddities: a null, empty or wordless text has the score of an empty text. A row's score
depends on its text alone: repeated rows score alike. Labels that are null do not count. Without
labels of both kinds, all scores are 0.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rainfold.llm.hashing import (
    U64,
    bytes_of,
    hash_ranges,
    pieces_of,
    reduce_by_text,
    spans,
)
from rainfold.llm.storage import stored

# What a character is read as.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t",
}
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_CODE = {c: i + 1 for i, c in enumerate(_LETTERS)}
_SIZE = len(_LETTERS) + 2  # 0 is a word's edge, the last any other letter
_OTHER = _SIZE - 1
# Costs, as log probabilities, of a changed character, a shortened run and a dropped sign.
_CHANGED, _SHORTENED, _DROPPED = -1.5, -0.7, -0.3

_SIGNS = re.escape("".join(LOOKALIKES))
_EDGE = rf"(?<![a-z{_SIGNS}])"
# A word with a look-alike before or between letters; single letters with one sign between them; a
# letter three times or more.
_SUSPECT = re.compile(
    rf"(?P<spaced>{_EDGE}[a-z{_SIGNS}](?:[ .\-_*][a-z{_SIGNS}]){{3,}}(?![a-z{_SIGNS}]))"
    rf"|(?P<word>{_EDGE}(?=[a-z{_SIGNS}]*[{_SIGNS}][a-z])(?=[a-z{_SIGNS}]*[a-z])[a-z{_SIGNS}]+"
    rf"|(?<![a-z])[a-z]*?([a-z])\3\3[a-z]*)"
)
# Bytes of which a text needs one to have a look-alike beside a letter, or a spaced word.
_HINT = re.compile(
    rb"[0134578@$!|+][A-Za-z]|([A-Za-z])\1\1|(?:^|[^A-Za-z0-9])[A-Za-z][ .\-_*][A-Za-z0-9@$!|+][ .\-_*]"
)


class CharacterModel:
    """Log probability of a character after two others, interpolated between the orders."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(_SIZE, _SIZE, _SIZE).astype(float)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one + 1).sum()
        p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
        p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(p3).tolist()

    def decode(self, written: str, spaced: bool = False) -> str:
        """The most likely reading; ``spaced`` takes signs between single letters for nothing."""
        # A state is the last two characters; it keeps its best score and the reading so far.
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        at = 0
        while at < len(written):
            c = written[at]
            run = 1
            while at + run < len(written) and written[at + run] == c:
                run += 1
            if spaced and not (c.isalpha() or c in LOOKALIKES):
                states = {s: (p + _DROPPED, r) for s, (p, r) in states.items()}
                at += run
                continue
            readings = [(c, 0.0)] if c in _CODE or c not in LOOKALIKES else []
            readings += [(x, _CHANGED) for x in LOOKALIKES.get(c, "")]
            lengths = [(run, 0.0)] if run < 3 else [(1, _SHORTENED), (2, _SHORTENED), (run, 0.0)]
            found: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (p, text) in states.items():
                for letter, changed in readings:
                    code = _CODE.get(letter, _OTHER)
                    for n, shortened in lengths:
                        x, y, q = a, b, p + changed * n + shortened
                        for _ in range(n):
                            q += self.log[x][y][code]
                            x, y = y, code
                        if (x, y) not in found or q > found[x, y][0]:
                            found[x, y] = (q, text + letter * n)
            states = found
            at += run
        ends = ((p + self.log[a][b][0], text) for (a, b), (p, text) in states.items())
        return max(ends, default=(0.0, ""))[1]


def count_characters(docs: DataFrame) -> np.ndarray:
    """How often each three characters stand together in all texts; 784 bytes-wide sums a task."""
    kind = np.full(256, 0, dtype=np.int64)
    kind[0x80:] = _OTHER
    for c, code in _CODE.items():
        kind[ord(c)] = kind[ord(c.upper())] = code

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        total = np.zeros(_SIZE**3, dtype=np.int64)
        for batch in batches:
            for first, last in pieces_of(batch.column("text"), 1 << 20):
                raw, bounds = bytes_of(batch.column("text").slice(first, last - first))
                for low in range(0, len(raw), 1 << 20):
                    # Two edges in front of each piece and one behind: texts start and end words.
                    codes = np.concatenate([[0, 0], kind[raw[low : low + (1 << 20)]], [0]])
                    three = (codes[:-2] * _SIZE + codes[1:-1]) * _SIZE + codes[2:]
                    total += np.bincount(three, minlength=_SIZE**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    rows = docs.select("text").mapInArrow(count, "at long, n long")
    counts = np.zeros(_SIZE**3, dtype=np.int64)
    for row in rows.groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[row["at"]] = row["n"]
    # After an edge the character before it does not matter.
    cube = counts.reshape(_SIZE, _SIZE, _SIZE)
    cube[0, 0] += cube[1:, 0].sum(axis=0)
    return counts


def restored(text: bytes, model: CharacterModel, known: dict[str, str]) -> bytes:
    """The text with every suspect span replaced by its most likely reading."""
    if not _HINT.search(text):
        return text

    def read(match: re.Match) -> str:
        span = match.group(0)
        if span not in known:
            if len(known) > 200_000:
                known.clear()
            known[span] = model.decode(span, match.group("spaced") is not None)
        return known[span]

    return _SUSPECT.sub(read, text.decode("utf-8", "replace").lower()).encode()


def restored_column(column: pa.Array, model: CharacterModel, known: dict[str, str]) -> pa.Array:
    texts = column.cast(pa.large_binary()).to_pylist()
    found = [restored(x, model, known) if x else b"" for x in texts]
    return pa.array(found, pa.large_binary()).cast(pa.large_string())


# Lengths in bytes of the stems that are types besides the whole word (0).
STEMS = (4, 5, 6, 7, 8)


def _types(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each word its types (whole word, then longer to shorter stems; 0 for none), and bounds."""
    raw, bounds = bytes_of(column)
    starts, ends = spans(raw, bounds, "letters")
    out = np.zeros((len(starts), 1 + len(STEMS)), dtype=U64)
    out[:, 0] = hash_ranges(raw, starts, ends)
    for k, stem in enumerate(sorted(STEMS, reverse=True)):
        long = np.flatnonzero(ends - starts > stem)
        # Not the hash of a word of that length.
        out[long, 1 + k] = hash_ranges(raw, starts[long], starts[long] + stem) ^ U64(0x5BD1E995)
    return out, np.searchsorted(starts, bounds, "left")


@dataclass
class Model:
    """Weights of the types that matter, the weight of all others, and the logistic curve."""

    characters: CharacterModel
    types: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    other: float = 0.0
    offset: float = -30.0
    slope: float = 0.0

    def sums(self, column: pa.Array) -> np.ndarray:
        """Each restored text's log ratio, before the curve."""
        types, bounds = _types(column)
        weight = np.full(len(types), self.other)
        if len(self.types):
            for k in reversed(range(types.shape[1])):
                at = np.minimum(np.searchsorted(self.types, types[:, k]), len(self.types) - 1)
                hit = self.types[at] == types[:, k]
                weight[hit] = self.weights[at[hit]]
        return reduce_by_text(weight, bounds, np.add, 0.0)

    def curve(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * sums, -30, 30)))


def _grouped_sums(labelled: DataFrame, of: Callable, schema: str, keys: list[str]) -> DataFrame:
    """Sums from ``of`` (restored texts and labels to columns), added up by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in pieces_of(batch.column("text"), 1 << 20):
                part = batch.slice(first, last - first)
                labels = np.asarray(part.column("label"))
                found = of(part.column("text"), labels)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in found.values()], names=list(found)
                )

    rows = labelled.select("text", "label").mapInArrow(run, schema)
    sums = [F.sum(c).alias(c) for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*sums)


def _restored_rows(labelled: DataFrame, characters: CharacterModel) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        for batch in batches:
            for first, last in pieces_of(batch.column("text"), 1 << 20):
                part = batch.slice(first, last - first)
                text = restored_column(part.column("text"), characters, known)
                yield pa.RecordBatch.from_arrays(
                    [text.cast(pa.string()), part.column("label")], names=["text", "label"]
                )

    return labelled.mapInArrow(run, "text string, label int")


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """text and label of about ``most`` labelled rows at most, the same ones in each run.

    The chosen labels are broadcast: their number is bounded, so the texts need no shuffle.
    """
    known = labels.where(f"doc_id is not null and {label} in (0, 1)").selectExpr(
        "cast(doc_id as bigint) as doc_id", f"cast({label} as int) as label"
    )
    part = min(1.0, most / max(1, known.count()))
    chosen = known.where(f"pmod(xxhash64(doc_id), 1048576) < {int(part * 1048576)}")
    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").join(
        F.broadcast(chosen), "doc_id"
    ).select("text", "label")


def fit(docs: DataFrame, labelled: DataFrame, least_gain: float = 12.0, types: int = 50_000) -> Model:
    """Learn from ``labelled`` (text, label); the character model is counted over ``docs``.

    A type is kept if its documents' labels differ from the base rate by a log-likelihood ratio of
    ``least_gain`` and a part that grows with the number of types tested; ``types`` bounds the model.
    """
    characters = CharacterModel(count_characters(docs))
    rows = stored(_restored_rows(labelled, characters), "restored")
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return Model(characters)

    def presence(column, labels) -> dict:
        types, bounds = _types(column)
        text = np.repeat(np.arange(len(labels)), np.diff(bounds))
        pairs = np.stack([np.tile(text, types.shape[1]).astype(U64), types.T.ravel()])
        pairs = pairs[:, pairs[1] > 0]
        order = np.lexsort(pairs)
        pairs = pairs[:, order]
        first = np.ones(pairs.shape[1], dtype=bool)
        first[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
        pairs = pairs[:, first]
        names, at = np.unique(pairs[1], return_inverse=True)
        is_bad = labels[pairs[0].astype(np.int64)] == 1
        return {
            "type": names.view(np.int64),
            "bad": np.bincount(at, is_bad, len(names)).astype(np.int64),
            "good": np.bincount(at, ~is_bad, len(names)).astype(np.int64),
        }

    seen = stored(_grouped_sums(rows, presence, "type long, bad long, good long", ["type"]), "types")
    tested = max(1, seen.where("bad + good >= 4").count())
    rate = bad / (bad + good)
    gain = (
        f"2 * (if(bad > 0, bad * ln(bad / (bad + good) / {rate}), 0)"
        f" + if(good > 0, good * ln(good / (bad + good) / {1 - rate}), 0))"
    )
    picked = (
        seen.withColumn("gain", F.expr(gain))
        .where(F.col("gain") >= least_gain + 2 * math.log(tested))
        # Types of both directions matter only if they are rare on one side.
        .where(f"bad / (bad + good) > {rate}")
        .orderBy(F.desc("gain"), "type")
        .limit(types)
        .select("type")
        .collect()
    )
    chosen = np.sort(np.array([r["type"] for r in picked], dtype=np.int64).view(U64))

    def occurrences(column, labels) -> dict:
        types, bounds = _types(column)
        found = np.zeros(len(types), dtype=np.int64)
        if len(chosen):
            for k in reversed(range(types.shape[1])):
                at = np.minimum(np.searchsorted(chosen, types[:, k]), len(chosen) - 1)
                hit = chosen[at] == types[:, k]
                found[hit] = at[hit] + 1
        is_bad = np.repeat(labels == 1, np.diff(bounds))
        size = len(chosen) + 1
        return {
            "at": np.arange(size),
            "bad": np.bincount(found, is_bad, size).astype(np.int64),
            "good": np.bincount(found, ~is_bad, size).astype(np.int64),
        }

    counts = np.ones((2, len(chosen) + 1)) * 0.5
    for r in _grouped_sums(rows, occurrences, "at long, bad long, good long", ["at"]).collect():
        counts[:, r["at"]] += r["bad"], r["good"]
    ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    model = Model(characters, chosen, ratio[1:], float(ratio[0]), slope=1.0, offset=0.0)

    def histogram(column, labels) -> dict:
        sums = np.clip(np.round(model.sums(column) * 4), -400, 400).astype(np.int64)
        cells, at = np.unique(sums, return_inverse=True)
        return {
            "cell": cells,
            "bad": np.bincount(at, labels == 1, len(cells)).astype(np.int64),
            "good": np.bincount(at, labels == 0, len(cells)).astype(np.int64),
        }

    # At most 801 rows.
    cells = _grouped_sums(rows, histogram, "cell long, bad long, good long", ["cell"]).collect()
    x = np.array([r["cell"] / 4 for r in cells])
    n1 = np.array([r["bad"] for r in cells], dtype=float)
    n0 = np.array([r["good"] for r in cells], dtype=float)
    model.offset, model.slope = _logistic(x, n1, n0)
    return model


def _logistic(x: np.ndarray, n1: np.ndarray, n0: np.ndarray) -> tuple[float, float]:
    """Newton's steps for offset and slope, lightly held back; the slope stays positive."""
    x = np.clip(x, -20, 20)
    a, b = math.log((n1.sum() + 1) / (n0.sum() + 1)), 0.1
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        gap, w = n1 - (n1 + n0) * p, (n1 + n0) * p * (1 - p)
        g0, g1 = gap.sum() - 1e-3 * a, (gap * x).sum() - 1e-3 * b
        h00, h01, h11 = w.sum() + 1e-3, (w * x).sum(), (w * x * x).sum() + 1e-3
        d = h00 * h11 - h01 * h01
        da, db = (h11 * g0 - h01 * g1) / d, (h00 * g1 - h01 * g0) / d
        step = min(1.0, 2.0 / max(abs(da), abs(db), 1e-9))
        a, b = a + step * da, max(b + step * db, 1e-3)
    return a, b


def score(text: Column, model: Model) -> Column:
    """The score of a column of texts, 0 to 1."""

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, str] = {}
        for part in parts:
            column = pa.array(part, pa.large_string(), from_pandas=True)
            out = np.zeros(len(column))
            for first, last in pieces_of(column, 1 << 20):
                out[first:last] = model.sums(restored_column(column.slice(first, last - first), model.characters, known))
            yield pd.Series(model.curve(out))

    return scored(text)
