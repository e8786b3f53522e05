"""Benchmark decontamination: every passage of every document is a query to an index of test items.

The index is an inverted one with BM25 impacts, each divided by its item's score against itself, so
that one threshold holds for all items. Items are numbered by length; every term's list is divided
into blocks of ``BLOCK`` items, and list and blocks know their largest impact. A passage is a window
of two strides of words, each as long as the longest item, so that every run of that length lies in
some passage. All items above the threshold are retrieved. Whole batches of passages are first held
against the blocks' bounds: the most frequent terms can together give an item of a block no more than
a share known from the items, so the block's largest impacts for the passage's other terms have to
make up the rest. Passages that reach it in any block go through the lists by block-max WAND. A hit
is confirmed on word trigrams: the passage has to hold enough of the item's question and enough of its
answer. A part of an item that is too short for a trigram is confirmed on the item's pairs of
neighbouring words that touch it, or on its word where the item has no other. Of a document's passages
the best figures for each item are reported.

The index is built in shards of items with a bounded size, each broadcast for one pass over the
documents; a shard is a collection with its own BM25 statistics. One shard holds about 20,000 items.

Nulls and oddities: null or empty texts have no passages. Items without words are left out. Words are
runs of ASCII letters, digits and all other characters, A-Z lower-cased. Repeated items and documents
are each reported.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rainfold.llm.hashing import U64, Words, pieces_of, shingles_of, words_of
from rainfold.llm.storage import row_key, stored

# Items in a block, words in a confirmed run, and the text in a shard of the index.
BLOCK = 4
RUN = 3
SHARD_BYTES = 4 << 20
_K1, _B = 1.2, 0.75


@dataclass(frozen=True)
class Rule:
    """Shares of an item's own score, and of the trigrams of its question and answer."""

    score: float = 0.5
    question: float = 0.5
    answer: float = 0.5


def questions_and_answers(benchmark: DataFrame) -> DataFrame:
    """item_id, question and answer from item_id and text.

    The answer is the last sentence; in a text of one sentence, the second half of its words.
    """
    parts = benchmark.selectExpr(
        "cast(item_id as bigint) as item_id",
        "filter(split(coalesce(text, ''), '(?<=[.!?])\\\\s+'), x -> length(x) > 0) as sentences",
    ).selectExpr(
        "item_id",
        "if(size(sentences) > 1, sentences, split(array_join(sentences, ' '), '\\\\s+')) as parts",
        "if(size(sentences) > 1, size(sentences) - 1, size(split(array_join(sentences, ' '),"
        " '\\\\s+')) div 2) as asked",
    )
    return parts.selectExpr(
        "item_id",
        "array_join(slice(parts, 1, asked), ' ') as question",
        "array_join(slice(parts, asked + 1, size(parts)), ' ') as answer",
    )


class Index:
    """Terms, their lists of items with impacts, and the items' question and answer trigrams."""

    def __init__(self, items: list[tuple[int, str, str]], rule: Rule):
        self.rule = rule
        texts = [f"{q or ''} {a or ''}" for _, q, a in items]
        whole, _, _ = words_of(pa.array(texts, pa.string()), "letters")
        sizes = whole.counts()
        order = [i for i in np.argsort(sizes, kind="stable") if sizes[i]]
        self.item_ids = [items[i][0] for i in order]
        self.longest = int(max((sizes[i] for i in order), default=1))
        self.runs = []
        pairs, pair_bounds = shingles_of(whole, 2)
        for part in (1, 2):
            texts = pa.array([items[i][part] or "" for i in order], pa.string())
            words, _, _ = words_of(texts, "letters")
            hashes, bounds = shingles_of(words, RUN)
            found = []
            for k, i in enumerate(order):
                size = int(words.bounds[k + 1] - words.bounds[k])
                if size >= RUN:
                    found.append(np.unique(hashes[bounds[k] : bounds[k + 1]]))
                    continue
                own = pairs[pair_bounds[i] : pair_bounds[i + 1]]
                if sizes[i] == 1:
                    own = whole.hashes[whole.bounds[i] : whole.bounds[i + 1]]
                touching = own[:size] if part == 1 else own[len(own) - min(size, len(own)) :]
                found.append(np.unique(touching))
            self.runs.append(found)
        self._lists(items, order)

    def _lists(self, items: list[tuple[int, str, str]], order: list[int]) -> None:
        texts = [f"{items[i][1] or ''} {items[i][2] or ''}" for i in order]
        words, _, _ = words_of(pa.array(texts, pa.string()), "letters")
        counted = [
            Counter(words.hashes[a:b].tolist())
            for a, b in zip(words.bounds[:-1], words.bounds[1:])
        ]
        n, mean = len(counted), max(1.0, float(words.counts().mean()) if len(counted) else 1.0)
        seen = Counter(term for counts in counted for term in counts)
        weight = {t: math.log(1 + (n - df + 0.5) / (df + 0.5)) for t, df in seen.items()}
        lists: dict[int, list[tuple[int, float]]] = {}
        for number, counts in enumerate(counted):
            length = sum(counts.values())
            part = {
                t: weight[t] * f * (_K1 + 1) / (f + _K1 * (1 - _B + _B * length / mean))
                for t, f in counts.items()
            }
            total = sum(part.values()) or 1.0
            for t, impact in part.items():
                lists.setdefault(t, []).append((number, impact / total))
        self.terms = np.array(sorted(lists), dtype=U64)
        self.items_of = [[x for x, _ in lists[t]] for t in self.terms.tolist()]
        self.impacts_of = [[x for _, x in lists[t]] for t in self.terms.tolist()]
        self.most = np.array([max(x) for x in self.impacts_of], dtype=float)
        self.block_most = []
        for numbers, impacts in zip(self.items_of, self.impacts_of):
            blocks: dict[int, float] = {}
            for number, impact in zip(numbers, impacts):
                blocks[number // BLOCK] = max(blocks.get(number // BLOCK, 0.0), impact)
            self.block_most.append(blocks)
        self._common_terms(len(counted))
        self.slots = np.zeros(1 << 16, dtype=bool)
        self.slots[(self.terms >> U64(48)).astype(np.int64)] = True

    def _common_terms(self, items: int) -> None:
        """Frequent terms, as long as no item gets more than half the threshold from all of them."""
        share = np.zeros(items)
        self.rare = np.ones(len(self.terms), dtype=bool)
        for t in sorted(range(len(self.terms)), key=lambda t: -len(self.items_of[t])):
            added = share[self.items_of[t]] + self.impacts_of[t]
            if added.max() <= self.rule.score / 2:
                share[self.items_of[t]] = added
                self.rare[t] = False
        # What a block's items need from other terms, and those terms' blocks with their bounds.
        blocks = -(-items // BLOCK)
        common = np.zeros(blocks)
        np.maximum.at(common, np.arange(items) // BLOCK, share)
        self.needed = self.rule.score - common - 1e-9
        lists = [sorted(self.block_most[t].items()) if self.rare[t] else [] for t in range(len(self.terms))]
        self.block_edges = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        self.blocks = np.array([b for x in lists for b, _ in x], dtype=np.int64)
        self.bounds = np.array([m for x in lists for _, m in x], dtype=float)

    def hopeful(self, passage: np.ndarray, term: np.ndarray) -> np.ndarray:
        """The passages that reach what some block needs. Pairs of passages and their rare terms."""
        first, n = self.block_edges[term], np.diff(self.block_edges)[term]
        at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        blocks = len(self.needed)
        cells, own = np.unique(np.repeat(passage, n) * blocks + self.blocks[at], return_inverse=True)
        reached = np.bincount(own, self.bounds[at], len(cells)) >= self.needed[cells % blocks]
        return np.unique(cells[reached] // blocks)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The term of each word, -1 for words that no item has."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        maybe = np.flatnonzero(self.slots[(hashes >> U64(48)).astype(np.int64)])
        if len(maybe):
            wanted = hashes[maybe]
            at = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
            hit = self.terms[at] == wanted
            out[maybe[hit]] = at[hit]
        return out

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """All items whose score for these terms is at least the threshold: block-max WAND."""
        least = self.rule.score - 1e-9
        # Cursors: current item, term, position in its list.
        cursors = sorted((self.items_of[t][0], t, 0) for t in terms)
        found = []
        while cursors:
            bound, pivot = 0.0, -1
            for k, (_, t, _) in enumerate(cursors):
                bound += self.most[t]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK
            in_block = sum(self.block_most[t].get(block, 0.0) for _, t, _ in cursors[: pivot + 1])
            if in_block >= least:
                score = 0.0
                for number, t, at in cursors[: pivot + 1]:
                    at = bisect_left(self.items_of[t], item, at)
                    if at < len(self.items_of[t]) and self.items_of[t][at] == item:
                        score += self.impacts_of[t][at]
                if score >= least:
                    found.append((item, score))
                following = item + 1
            else:
                # No item of this block can do it, up to the next list's start.
                following = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    following = max(item + 1, min(following, cursors[pivot + 1][0]))
            moved = []
            for number, t, at in cursors[: pivot + 1]:
                at = bisect_left(self.items_of[t], following, at)
                if at < len(self.items_of[t]):
                    moved.append((self.items_of[t][at], t, at))
            cursors = sorted(moved + cursors[pivot + 1 :])
        return found

    def confirm(self, item: int, runs: np.ndarray) -> tuple[float, float]:
        """Shares of the item's question and answer trigrams among ``runs`` (sorted)."""
        shares = []
        for part in self.runs:
            wanted = part[item]
            held = len(np.intersect1d(wanted, runs, assume_unique=True)) if len(wanted) else 0
            shares.append(held / len(wanted) if len(wanted) else 1.0)
        return shares[0], shares[1]


def _passages(words: Words, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's number of passages, and each word's stride within its text."""
    counts = words.counts()
    place = np.arange(len(words.hashes)) - np.repeat(words.bounds[:-1], counts)
    return np.maximum(1, -(-counts // stride) - 1) * (counts > 0), place // stride


def _hits(words: Words, index: Index) -> Iterator[tuple[int, int, float, float, float]]:
    """(text, item, score, question share, answer share) of confirmed passages."""
    stride = max(RUN, index.longest)
    passages, strides = _passages(words, stride)
    base = np.concatenate([[0], np.cumsum(passages)])
    terms = index.numbers(words.hashes)
    at = np.flatnonzero(terms >= 0)
    at = at[index.rare[terms[at]]]
    text = words.texts()[at]
    found = []
    # A word is in the passage that starts with its stride and in the one before.
    for back in (0, 1):
        passage = strides[at] - back
        inside = (passage >= 0) & (passage < passages[text])
        found.append((base[text[inside]] + passage[inside]) * len(index.terms) + terms[at][inside])
    keys = np.unique(np.concatenate(found))
    if not len(keys):
        return
    passage, term = keys // len(index.terms), keys % len(index.terms)
    for p in index.hopeful(passage, term).tolist():
        text = int(np.searchsorted(base, p, "right")) - 1
        first = int(words.bounds[text]) + (p - int(base[text])) * stride
        last = min(first + 2 * stride, int(words.bounds[text + 1]))
        held = np.unique(terms[first:last])
        hits = index.search(held[held >= 0].tolist())
        if not hits:
            continue
        window = Words(words.hashes[first:last], None, None, np.array([0, last - first]))
        shingles = [shingles_of(window, size)[0] for size in (RUN, 2)]
        runs = np.unique(np.concatenate([*shingles, window.hashes]))
        for item, score in hits:
            question, answer = index.confirm(item, runs)
            if question >= index.rule.question and answer >= index.rule.answer:
                yield text, item, score, question, answer


_SCHEMA = "doc_id long, item_id long, score double, question_share double, answer_share double"


def _shards(items: DataFrame, rule: Rule) -> list[Index]:
    """Indexes of bounded size. Items' shards are the same in each run."""
    sized = items.agg(F.expr("sum(length(question) + length(answer))").alias("n")).first()["n"]
    number = max(1, math.ceil((sized or 0) / SHARD_BYTES))
    shards = []
    for shard in range(number):
        part = items.where(f"pmod(xxhash64(item_id, question), {number}) = {shard}")
        rows = sorted(tuple(r) for r in part.selectExpr("coalesce(item_id, -1)", "question", "answer").collect())
        shards.append(Index(rows, rule))
    return [x for x in shards if x.item_ids]


def _found(docs: DataFrame, items: DataFrame, rule: Rule) -> DataFrame:
    """Each row's hits, with the two hashes of its text."""
    spark = docs.sparkSession
    key = F.expr(row_key())
    source = docs.select(F.col("doc_id").cast("long"), "text", *(key[c].alias(c) for c in ("a", "b")))
    schema = f"{_SCHEMA}, a long, b long"
    found = spark.createDataFrame([], schema)
    for index in _shards(items, rule):
        held = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held.value
            for batch in batches:
                for first, last in pieces_of(batch.column("text"), 2 << 20):
                    part = batch.slice(first, last - first)
                    words, _, _ = words_of(part.column("text"), "letters")
                    ids, *keys = (part.column(c).to_pylist() for c in ("doc_id", "a", "b"))
                    rows = [
                        (ids[t], index.item_ids[i], s, q, a, keys[0][t], keys[1][t])
                        for t, i, s, q, a in _hits(words, index)
                    ]
                    columns = list(zip(*rows)) or [[]] * 7
                    kinds = [pa.int64()] * 2 + [pa.float64()] * 3 + [pa.int64()] * 2
                    names = ["doc_id", "item_id", "score", "question_share", "answer_share", "a", "b"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
                    )

        found = found.unionByName(source.mapInArrow(search, schema))
    return found


def contaminated(docs: DataFrame, items: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id and item_id of every document that holds an item, with the best passage's figures."""
    return _found(docs, items, rule).groupBy("doc_id", "item_id").agg(
        F.max("score").alias("score"),
        F.max("question_share").alias("question_share"),
        F.max("answer_share").alias("answer_share"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` without the rows that hold an item.

    Rows that repeat a doc_id, and those with a null one, are decided by their own text.
    """
    hits = stored(_found(docs, items, rule).select("doc_id", "a", "b"), "contaminated")
    gone = hits.distinct().selectExpr("doc_id as rf_gone", "struct(a, b) as rf_key")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("rf_gone")) & (F.expr(row_key()) == F.col("rf_key"))
    return docs.join(gone, same, "left_anti")
