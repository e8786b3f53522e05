"""Token counts by greedy longest match, in linear time, without building the tokens.

A vocabulary holds pieces that start a word and pieces that continue one. A word's tokens are the
longest piece that starts it, then again and again the longest that continues it; a word that cannot
be finished so counts as one unknown token. The automaton is the trie of all pieces, with a second
root for continuing pieces. Where a character does not continue a node, its failure link leads to the
node for what is left after the tokens that are certain by then, and a number beside it says how
many tokens those are; tokens are only ever counted. Each character moves forward once.

Words are runs of ASCII letters, digits and non-ASCII characters; every other character but ASCII
white space is a word of its own. Each batch runs the automaton once for each different word that
its process has not met.

Nulls and oddities: a null or empty text has no words and no tokens. A character unknown to the
vocabulary makes its word unknown. doc_id is only passed on.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rainfold.llm.hashing import bytes_of, hash_ranges, pieces_of, reduce_by_text, separators, spans

# Fixed value: words whose counts a process remembers.
REMEMBERED = 1 << 19
_SHIFT = 21  # code points are below 2**21


class Automaton:
    """Trie with failure links and popped-token counts. Node 0 starts words, node 1 continues them."""

    def __init__(self, first: Iterable[str], later: Iterable[str]):
        self.next: dict[int, int] = {}
        ends, parent, children = [False, False], [(0, 0), (1, 0)], [[], []]
        for root, pieces in ((0, first), (1, later)):
            for piece in pieces:
                node = root
                for c in map(ord, piece):
                    child = self.next.get(node << _SHIFT | c)
                    if child is None:
                        child = len(ends)
                        self.next[node << _SHIFT | c] = child
                        ends.append(False)
                        parent.append((node, c))
                        children.append([])
                        children[node].append(child)
                    node = child
                ends[node] = ends[node] or node > 1
        self.fail, self.pops = [-1] * len(ends), [0] * len(ends)
        queue = deque(children[0] + children[1])
        while queue:
            node = queue.popleft()
            queue.extend(children[node])
            if ends[node]:
                self.fail[node], self.pops[node] = 1, 1
                continue
            up, c = parent[node]
            at, popped = self.fail[up], self.pops[up]
            while at >= 0 and (at << _SHIFT | c) not in self.next:
                popped, at = popped + self.pops[at], self.fail[at]
            if at >= 0:
                self.fail[node], self.pops[node] = self.next[at << _SHIFT | c], popped

    def count(self, word: str) -> int:
        """Tokens of a word that is not empty."""
        follow, fail, pops = self.next, self.fail, self.pops
        node, tokens = 0, 0
        for c in map(ord, word):
            child = follow.get(node << _SHIFT | c)
            while child is None:
                if fail[node] < 0:
                    return 1
                tokens += pops[node]
                node = fail[node]
                child = follow.get(node << _SHIFT | c)
            node = child
        while node != 1:
            if fail[node] < 0:
                return 1
            tokens += pops[node]
            node = fail[node]
        return tokens


@cache
def automaton(model_file: str) -> Automaton:
    """From a sentencepiece file: pieces with its word mark start words, all others continue them."""
    import sentencepiece

    held = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [
        held.id_to_piece(i)
        for i in range(held.get_piece_size())
        if not (held.is_control(i) or held.is_unknown(i) or held.is_byte(i))
    ]
    mark = "▁"
    return Automaton(
        [p[1:] for p in pieces if p.startswith(mark) and len(p) > 1],
        [p for p in pieces if not p.startswith(mark)],
    )


def token_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_words and n_tokens of every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = automaton(model_file), {}
        letters, space = separators("letters"), separators("space")
        for batch in batches:
            for first, last in pieces_of(batch.column("text"), 2 << 20):
                part = batch.slice(first, last - first)
                raw, bounds = bytes_of(part.column("text"))
                starts, ends = spans(raw, bounds, "letters")
                hashes, first_at, at = np.unique(
                    hash_ranges(raw, starts, ends, fold=False), return_index=True, return_inverse=True
                )
                tokens = np.zeros(len(hashes), dtype=np.int64)
                for i, key in enumerate(hashes.tolist()):
                    n = known.get(key)
                    if n is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        word = raw[starts[first_at[i]] : ends[first_at[i]]].tobytes()
                        n = known[key] = machine.count(word.decode("utf-8", "replace"))
                    tokens[i] = n
                signs = np.flatnonzero(letters[raw] & ~space[raw])
                alone = np.diff(np.searchsorted(signs, bounds))
                word_bounds = np.searchsorted(starts, bounds)
                in_words = reduce_by_text(tokens[at], word_bounds, np.add, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(word_bounds) + alone),
                        pa.array(in_words + alone),
                    ],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        count, "doc_id long, n_words long, n_tokens long"
    )
