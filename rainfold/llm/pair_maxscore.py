"""Ranked lexical search: MaxScore whose bounds come from pairs of terms.

The collection is indexed in blocks of documents. A block holds, for every term of the queries, the
list of its documents with their rates and the list's largest one, and for chosen pairs of terms the
list of documents that hold both with the largest joint impact there. For a pair (a, b) no document of
the block gets more from both than max(U(a), U(b), J(a, b)), which is less than U(a) + U(b) wherever
the two peaks lie in different documents, and about half of it where the terms never meet.

At query time an item's terms are combined into disjoint pairs by the bound they save, the best first;
pairs and left-over terms are the units of MaxScore. Units whose bounds together stay below the item's
k-th score so far need not be opened to find candidates; a block whose units all together stay below it
is skipped. Candidates come from the lists of the other units, take up the rest unit by unit, and are
given up as soon as what they have and what is left is below the k-th score. That score is carried from
block to block. Equal scores count as reached, so ties are settled by doc_id and the result is exact.

Pairs are chosen from the items: terms next to each other in order of weight, since a pair of like
weights saves most. Which pairs are stored affects speed only.

A term is a maximal run of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased; it
is known by a 64-bit hash. With N documents that hold a term, L their terms with repeats, n a
document's, df the documents with a term and tf its repeats in one: weight
w = floor(1000 ln((2N+2) / (2df+1))), m = 100 - 90 + (90 n N) div L, rate = 10^9 tf div (1000 tf + 8 m),
and a score is the sum of w * rate over an item's terms. The formula is a fixed value.

Stages: one pass over the texts writes for each document its count of terms and its repeats of the
items' terms; statistics are aggregations of that table; the next pass writes the blocks; the last one
searches them. Items are dealt into shards of a bounded number of terms; what is broadcast and
collected is one shard's terms at a time. Each task returns k documents an item, the best k of all are
ranked by a window with a group limit.

Nulls and oddities: null and empty texts hold no term and are not counted. Rows that repeat a doc_id
are documents of their own; a null doc_id comes last among equal scores. Rows that repeat an item_id
are one item with all their terms. Items without a term, and those that no document matches with a
score above 0, have no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rainfold.llm.hashing import U64, pieces_of, words_of
from rainfold.llm.storage import discard, stored

# Item terms in a shard, postings and documents in a block.
SHARD_TERMS = 500_000
BLOCK_POSTINGS, BLOCK_DOCS = 1 << 18, 1 << 14
_LAST = np.iinfo(np.int64).max

_BLOCK = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())),
        ("terms", pa.list_(pa.int32())),
        ("term_starts", pa.list_(pa.int32())),
        ("term_docs", pa.list_(pa.int32())),
        ("term_rates", pa.list_(pa.int32())),
        ("term_best", pa.list_(pa.int32())),
        ("pairs", pa.list_(pa.int32())),
        ("pair_starts", pa.list_(pa.int32())),
        ("pair_docs", pa.list_(pa.int32())),
        ("pair_best", pa.list_(pa.int64())),
    ]
)
_BLOCK_DDL = ", ".join(
    f"{f.name} array<{'long' if f.type.value_type == pa.int64() else 'int'}>" for f in _BLOCK
)


@dataclass
class Vocabulary:
    """A shard's items and terms. Items' terms are numbers into ``hashes``; pairs likewise."""

    hashes: np.ndarray
    item_ids: list
    item_terms: list[np.ndarray]
    weights: np.ndarray | None = None
    pairs: np.ndarray | None = None
    item_pairs: list[np.ndarray] | None = None
    documents: int = 0
    length: int = 0

    def __post_init__(self):
        self.slots = np.zeros(1 << 16, dtype=bool)
        self.slots[(self.hashes >> U64(48)).astype(np.int64)] = True

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that are terms here, and their numbers."""
        at = np.flatnonzero(self.slots[(hashes >> U64(48)).astype(np.int64)])
        if not len(at):
            return at, at
        number = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        hit = self.hashes[number] == hashes[at]
        return at[hit], number[hit]

    def weigh(self, documents: int, length: int, frequency: np.ndarray) -> None:
        """Take up the collection's statistics and choose the pairs to store."""
        self.documents, self.length = documents, length
        self.weights = np.array(
            [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequency],
            dtype=np.int64,
        )
        found: dict[tuple[int, int], int] = {}
        self.item_pairs = []
        for terms in self.item_terms:
            order = terms[np.lexsort((terms, -self.weights[terms]))].tolist()
            own = []
            for a, b in zip(order, order[1:]):
                pair = (min(a, b), max(a, b))
                own.append(found.setdefault(pair, len(found)))
            self.item_pairs.append(np.array(own, dtype=np.int64))
        self.pairs = np.array(list(found) or np.zeros((0, 2)), dtype=np.int64).reshape(-1, 2)


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, _, _ = words_of(batch.column("text"), "letters")
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item_id").take(pa.array(words.texts())),
                pa.array(words.hashes.view(np.int64)),
            ],
            names=["item_id", "term"],
        )


def _vocabularies(items: DataFrame) -> Iterator[Vocabulary]:
    """The items' terms in shards of bounded size, one at a time."""
    texts = items.selectExpr("cast(item_id as bigint) as item_id", "text")
    terms = stored(
        texts.mapInArrow(_term_rows, "item_id long, term long").distinct(), "item-terms"
    )
    shards = max(1, math.ceil(terms.count() / SHARD_TERMS))
    for shard in range(shards):
        part = terms.where(f"pmod(xxhash64(item_id), {shards}) = {shard}").toArrow()
        if not part.num_rows:
            continue
        hashes = part.column("term").to_numpy().view(U64)
        ids = part.column("item_id").to_pylist()
        known = np.unique(hashes)
        by_item: dict = {}
        for item, number in zip(ids, np.searchsorted(known, hashes).tolist()):
            by_item.setdefault(item, []).append(number)
        order = sorted(by_item, key=lambda i: (i is None, i))
        yield Vocabulary(known, order, [np.unique(by_item[i]) for i in order])


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))


def _counted(docs: DataFrame, held) -> DataFrame:
    """doc_id, n, and the shard's terms with their repeats, for each document with a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        size = len(known.hashes)
        for batch in batches:
            for first, last in pieces_of(batch.column("text")):
                part = batch.slice(first, last - first)
                words, _, _ = words_of(part.column("text"), "letters")
                n = words.counts()
                at, number = known.numbers(words.hashes)
                text = np.searchsorted(words.bounds, at, "right") - 1
                keys, repeats = np.unique(text * size + number, return_counts=True)
                bounds = np.searchsorted(keys, np.arange(len(n) + 1) * size)
                rows = pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(n, pa.int64()),
                        _lists(keys % size, bounds),
                        _lists(repeats, bounds),
                    ],
                    names=["doc_id", "n", "terms", "repeats"],
                )
                yield rows.filter(pa.array(n > 0))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(count, "doc_id long, n long, terms array<int>, repeats array<int>")


def _expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all ranges that begin at ``starts`` and hold ``counts`` numbers."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def make_block(
    doc_ids: pa.Array, n: np.ndarray, doc: np.ndarray, term: np.ndarray, repeats: np.ndarray,
    known: Vocabulary,
) -> dict:
    """Lists of terms and pairs of one block; ``doc`` and ``term`` are the postings."""
    order = np.lexsort((doc, term))
    doc, term, repeats = doc[order], term[order], repeats[order].astype(np.int64)
    spread = 10 + (90 * n.astype(np.int64) * known.documents) // known.length
    rates = 1_000_000_000 * repeats // (1000 * repeats + 8 * spread[doc])
    terms, starts = np.unique(term, return_index=True)
    ends = np.append(starts[1:], len(term))
    best = np.maximum.reduceat(rates, starts) if len(terms) else np.zeros(0, np.int64)
    # For each pair the shorter list's documents are looked up in the other list.
    place = np.full(len(known.hashes), -1)
    place[terms] = np.arange(len(terms))
    both = np.flatnonzero((place[known.pairs] >= 0).all(axis=1))
    a, b = place[known.pairs[both, 0]], place[known.pairs[both, 1]]
    swap = (ends - starts)[a] > (ends - starts)[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    size = (ends - starts)[a]
    at = _expand(starts[a], size)
    pair = np.repeat(np.arange(len(both)), size)
    keys = place[term] * (len(n) + 1) + doc
    wanted = np.repeat(b, size) * (len(n) + 1) + doc[at]
    other = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    hit = keys[other] == wanted if len(at) else np.zeros(0, bool)
    at, other, pair = at[hit], other[hit], pair[hit]
    joint = known.weights[term[at]] * rates[at] + known.weights[term[other]] * rates[other]
    met, pair_starts = np.unique(pair, return_index=True)
    return {
        "doc_ids": doc_ids,
        "terms": terms,
        "term_starts": np.append(starts, len(term)),
        "term_docs": doc,
        "term_rates": rates,
        "term_best": best,
        "pairs": both[met],
        "pair_starts": np.append(pair_starts, len(pair)),
        "pair_docs": doc[at],
        "pair_best": np.maximum.reduceat(joint, pair_starts) if len(met) else joint[:0],
    }


def _blocks(counted: DataFrame, held) -> DataFrame:
    """The index: a row for each block of documents."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        parts: list[pa.RecordBatch] = []
        docs = postings = 0

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts).combine_chunks()
            terms = rows.column("terms").combine_chunks()
            repeats = rows.column("repeats").combine_chunks()
            sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
            made = make_block(
                rows.column("doc_id").combine_chunks(),
                rows.column("n").to_numpy(),
                np.repeat(np.arange(len(sizes)), sizes),
                terms.flatten().to_numpy(),
                repeats.flatten().to_numpy(),
                known,
            )
            arrays = [
                pa.ListArray.from_arrays(
                    pa.array([0, len(made[f.name])], pa.int32()),
                    pa.array(made[f.name], f.type.value_type),
                )
                for f in _BLOCK
            ]
            return pa.RecordBatch.from_arrays(arrays, schema=_BLOCK)

        for batch in batches:
            sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
            first = 0
            for row, size in enumerate(sizes.tolist()):
                if docs and (docs == BLOCK_DOCS or postings + size > BLOCK_POSTINGS):
                    parts.append(batch.slice(first, row - first))
                    yield block()
                    parts.clear()
                    first, docs, postings = row, 0, 0
                docs, postings = docs + 1, postings + size
            parts.append(batch.slice(first))
        if docs:
            yield block()

    return counted.mapInArrow(build, _BLOCK_DDL)


@dataclass
class Best:
    """An item's best documents so far, and how many were scored to find them."""

    k: int
    scores: np.ndarray
    keys: np.ndarray
    scored: int = 0

    @classmethod
    def none(cls, k: int) -> Best:
        return cls(k, np.zeros(0, np.int64), np.zeros(0, np.int64))

    @property
    def least(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        self.scored += len(scores)
        scores, keys = np.append(self.scores, scores), np.append(self.keys, keys)
        top = np.lexsort((keys, -scores))[: self.k]
        self.scores, self.keys = scores[top], keys[top]


class Block:
    """One block of the index, opened for search."""

    def __init__(self, made: dict, known: Vocabulary):
        self.known, self.made = known, made
        self.keys = made["doc_keys"]
        self.place = np.full(len(known.hashes), -1)
        self.place[made["terms"]] = np.arange(len(made["terms"]))
        self.most = known.weights[made["terms"]] * made["term_best"].astype(np.int64)
        self.joint = np.zeros(len(known.pairs), dtype=np.int64)
        self.joint[made["pairs"]] = made["pair_best"]

    def units(self, item: int, pairs: bool = True) -> list[tuple[int, tuple[int, ...]]]:
        """The item's terms in disjoint pairs and singles with their bounds, largest first."""
        terms = self.known.item_terms[item]
        left = {int(t): int(self.most[self.place[t]]) for t in terms if self.place[t] >= 0}
        saved, out = [], []
        for pair in self.known.item_pairs[item].tolist() if pairs else []:
            a, b = self.known.pairs[pair].tolist()
            if a in left and b in left:
                bound = max(left[a], left[b], int(self.joint[pair]))
                saved.append((left[a] + left[b] - bound, bound, a, b))
        for gain, bound, a, b in sorted(saved, reverse=True):
            if gain and a in left and b in left:
                out.append((bound, (a, b)))
                del left[a], left[b]
        out += [(bound, (t,)) for t, bound in left.items()]
        return sorted(out, reverse=True)

    def _list(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at, starts = self.place[term], self.made["term_starts"]
        part = slice(starts[at], starts[at + 1])
        impacts = self.known.weights[term] * self.made["term_rates"][part].astype(np.int64)
        return self.made["term_docs"][part], impacts

    def search(self, item: int, best: Best, pairs: bool = True) -> None:
        units = self.units(item, pairs)
        rest = np.cumsum([0] + [bound for bound, _ in reversed(units)])[::-1].tolist()
        if rest[0] < best.least:
            return
        score = np.zeros(len(self.keys), dtype=np.int64)
        opened = 0
        while opened < len(units) and rest[opened] >= best.least:
            for term in units[opened][1]:
                docs, impacts = self._list(term)
                score[docs] += impacts
            opened += 1
        found = np.flatnonzero(score)
        found = found[score[found] + rest[opened] >= best.least]
        scores = score[found]
        for (_, terms), after in zip(units[opened:], rest[opened + 1 :]):
            if not len(found):
                return
            for term in terms:
                docs, impacts = self._list(term)
                at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                scores = scores + np.where(docs[at] == found, impacts[at], 0)
            hopeful = scores + after >= best.least
            found, scores = found[hopeful], scores[hopeful]
        best.add(scores, self.keys[found])


def _searched(blocks: DataFrame, held, k: int) -> DataFrame:
    """Each task's best documents of each item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        best = [Best.none(k) for _ in known.item_ids]
        for batch in batches:
            for row in range(batch.num_rows):
                made = {
                    f.name: batch.column(f.name)[row].values.to_numpy(zero_copy_only=False)
                    for f in _BLOCK
                    if f.name != "doc_ids"
                }
                ids = batch.column("doc_ids")[row].values
                made["doc_keys"] = ids.fill_null(_LAST).to_numpy()
                block = Block(made, known)
                for item, found in enumerate(best):
                    block.search(item, found)
        sizes = [len(found.keys) for found in best]
        items = pa.array(known.item_ids, pa.int64()).take(
            pa.array(np.repeat(np.arange(len(best)), sizes))
        )
        keys = np.concatenate([np.zeros(0, np.int64)] + [found.keys for found in best])
        scores = np.concatenate([np.zeros(0, np.int64)] + [found.scores for found in best])
        yield pa.RecordBatch.from_arrays(
            [items, pa.array(keys, mask=keys == _LAST), pa.array(scores)],
            names=["item_id", "doc_id", "score"],
        )

    return blocks.mapInArrow(search, "item_id long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    return found.selectExpr(
        "item_id",
        "row_number() over (partition by item_id order by score desc, doc_id asc nulls last)"
        " as rank",
        "doc_id",
        "score",
    ).where(F.col("rank") <= k)


def _search_shard(docs: DataFrame, known: Vocabulary, k: int) -> DataFrame:
    spark = docs.sparkSession
    context = spark.sparkContext
    paths: list[str] = []
    plain = context.broadcast(known)
    counted = stored(_counted(docs, plain), "term-counts", paths)
    documents, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = counted.selectExpr("explode(terms) as term").groupBy("term").count().toArrow()
    frequency = np.zeros(len(known.hashes), dtype=np.int64)
    frequency[held.column("term").to_numpy()] = held.column("count").to_numpy()
    known.weigh(documents, length, frequency)
    weighed = context.broadcast(known)
    blocks = stored(_blocks(counted, weighed), "pair-index", paths)
    ranked = stored(_ranked(_searched(blocks, weighed, k), k), "ranked")
    plain.destroy()
    weighed.destroy()
    discard(spark, *paths)
    return ranked


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score: each item's ``k`` best documents with a score above 0."""
    parts = [_search_shard(docs, known, k) for known in _vocabularies(items)]
    if not parts:
        return docs.sparkSession.createDataFrame(
            [], "item_id long, rank int, doc_id long, score long"
        )
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found
