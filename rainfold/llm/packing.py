"""Packing documents into sequences of a fixed number of tokens, by cutting stock.

A document's ids, with an end id, are cut at multiples of the sequence length, so that a piece
depends on its document alone and its checksum can be taken in the one pass that makes the ids. The
histogram of the pieces' lengths, in sizes of ``GRAIN`` tokens, goes to the driver; it has at most
``capacity / GRAIN`` rows. ``cutting_stock`` finds how sizes share sequences. Every pattern then
stands for a run of sequences, and the places for one size are numbered through all patterns. Pieces
of one size are ranked, in ``SLICES`` parts so that a frequent size is spread, and each piece takes
the place with its rank. Offsets add up the true lengths in each sequence, so that the tokens lost to
whole sizes, less than ``GRAIN`` a piece, are padding at the end.

Nulls and oddities: a null or empty text is the end id alone. doc_id is only passed on: it may be
null or repeat, and each row is packed. Rows alike in all respects take the places of their ranks in
either order, which gives the same result. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rainfold.llm import cutting_stock
from rainfold.llm.hashing import pieces_of
from rainfold.llm.storage import stored
from rainfold.llm.tokens import ids_of

# Tokens in a size, parts in which the pieces of one size are ranked, and texts' bytes
# at a time.
GRAIN = 8
SLICES = 64
_BATCH_BYTES = 4 << 20
_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """The pieces of each document; with their ids where asked for."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_for = ids_of(tokenizer)
        for batch in batches:
            for first, last in pieces_of(batch.column("text"), _BATCH_BYTES):
                part = batch.slice(first, last - first)
                rows = zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                yield _table([x for row in rows for x in _cut(*row, ids_for)])

    def _cut(doc_id, text, ids_for):
        ids = array("I", ids_for(text or ""))
        ids.append(end_id)
        for start in range(0, len(ids), capacity):
            piece = ids[start : start + capacity]
            yield doc_id, start, len(piece), zlib.crc32(piece), len(ids), piece

    def _table(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found))
        arrays = [pa.array(column, pa.int64()) for column in columns[:5]]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:
            arrays.append(pa.array([list(x) for x in columns[5]], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        pieces, _SCHEMA + (", ids array<int>" if with_ids else "")
    )


class Places:
    """Where the r-th piece of each size goes."""

    def __init__(self, taken: list[tuple[cutting_stock.Pattern, int]]):
        rows, sequence = [], 0
        used: dict[int, int] = {}
        for pattern, times in taken:
            slot = 0
            for size in sorted(pattern, reverse=True):
                first = used.get(size, 0)
                rows.append((size, first, sequence, times, slot))
                used[size] = first + pattern[size] * times
                slot += pattern[size]
            sequence += times
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
        self.size, self.first, self.sequence, self.times, self.slot = table.T

    def find(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and slot of the pieces with these sizes and ranks (from 0)."""
        # Sizes are below 2**16, ranks below 2**47.
        key = (self.size << 47) | self.first
        at = np.searchsorted(key, (size << 47) | rank, "right") - 1
        place = rank - self.first[at]
        return self.sequence[at] + place % self.times[at], self.slot[at] + place // self.times[at]


def ranked(pieces: DataFrame) -> DataFrame:
    """Each piece with its rank (from 0) among the pieces of its size."""
    dealt = pieces.withColumn("slice", F.expr(f"pmod(xxhash64(doc_id, start), {SLICES})"))
    counts = dealt.groupBy("size", "slice").agg(F.count("*").alias("n"))
    # At most SLICES rows for each size.
    before = counts.selectExpr(
        "size",
        "slice",
        "coalesce(sum(n) over (partition by size order by slice"
        " rows between unbounded preceding and 1 preceding), 0) as earlier",
    )
    numbered = dealt.withColumn(
        "place",
        F.expr(
            "row_number() over (partition by size, slice"
            " order by doc_id, start, length, ids_crc32) - 1"
        ),
    )
    return (
        numbered.join(before, ["size", "slice"])
        .withColumn("rank", F.expr("earlier + place"))
        .drop("slice", "earlier", "place")
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece.

    ``capacity`` is a multiple of ``GRAIN``. ``tokenizer`` is the path of a byte-level BPE file that every machine has; ``with_ids`` adds
    the pieces' ids.
    """
    pieces = stored(
        cut(docs, tokenizer, capacity, end_id, with_ids).withColumn(
            "size", F.expr(f"cast(ceil(length / {GRAIN}) as bigint)")
        ),
        "pieces",
    )
    # At most ``capacity / GRAIN`` rows.
    histogram = pieces.groupBy("size").agg(F.count("*").alias("n")).collect()
    demand = {row["size"]: row["n"] for row in histogram}
    bins = capacity // GRAIN
    places = Places(cutting_stock.rounded(cutting_stock.solve(demand, bins), demand, bins))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence, slot = places.find(frame["size"].to_numpy(), frame["rank"].to_numpy())
            yield frame.drop(columns=["size", "rank"]).assign(sequence_id=sequence, slot=slot)

    ids = ["ids"] if with_ids else []
    schema = _SCHEMA + (", ids array<int>" if with_ids else "")
    placed = (
        ranked(pieces)
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", *ids, "size", "rank")
        .mapInPandas(assign, schema + ", sequence_id long, slot long")
    )
    # A sequence has at most ``capacity`` pieces.
    return placed.withColumn(
        "offset",
        F.expr(
            "coalesce(sum(length) over (partition by sequence_id order by slot"
            " rows between unbounded preceding and 1 preceding), 0)"
        ),
    ).drop("slot")
