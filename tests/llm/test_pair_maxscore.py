import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from rainfold.llm import pair_maxscore
from rainfold.llm.pair_maxscore import Best, Block, Vocabulary, make_block, rank_documents
from tests.llm.conftest import WORDS, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute_force(docs, items, k):
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in wanted.items():
        scores = []
        for doc, c in counted:
            m = 10 + 90 * sum(c.values()) * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms
                if t in c
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def found(spark, docs, items, k=10):
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "1 as n", "'x' as terms", "2.0 as score"
    )
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 as rank")
    ranked = rank_documents(table.repartition(3), asked, k)
    assert ranked.dtypes == [
        ("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint"),
    ]
    return Counter(tuple(r) for r in ranked.collect())


def case(seed, docs=300):
    rng = random.Random(seed)
    rows = [(i, prose(seed * 1000 + i, rng.randrange(1, 120))) for i in range(docs)]
    copy = prose(seed, 40)
    rows += [(1000 + i, copy) for i in range(30)]  # ties
    rows += [(5, copy), (5, copy), (None, copy), (-3, None), (-4, ""), (-5, "!? ..."),
             (7000, "Ärger über ÜBER " + WORDS[0].upper() + "3"), (7001, prose(9, 30_000))]
    items = [(i, prose(seed + i, rng.randrange(1, 30))) for i in range(12)]
    items += [(20, copy), (21, None), (22, "?"), (23, "nowhere found"), (24, "über ärger"),
              (24, WORDS[1] + "5"), (None, copy), (25, prose(2, 4000))]
    return rows, items


def test_against_brute_force(spark, monkeypatch):
    rows, items = case(3)
    assert found(spark, rows, items) == brute_force(rows, items, 10)
    monkeypatch.setattr(pair_maxscore, "BLOCK_DOCS", 16)
    monkeypatch.setattr(pair_maxscore, "BLOCK_POSTINGS", 700)
    rows, items = case(4)
    assert found(spark, rows, items, 4) == brute_force(rows, items, 4)


def test_several_shards(spark, monkeypatch):
    monkeypatch.setattr(pair_maxscore, "SHARD_TERMS", 60)
    rows, items = case(5, 80)
    assert found(spark, rows, items) == brute_force(rows, items, 10)


def test_empty_tables(spark):
    rows, items = [(1, "one two")], [(1, "two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert rank_documents(docs.where("false"), asked).count() == 0
    assert rank_documents(docs, asked.where("false")).count() == 0


def block_of(rng, docs, terms):
    """A block of random documents, whose index the search gets directly."""
    known = Vocabulary(np.arange(1, terms + 1, dtype=np.uint64), [0], [np.arange(terms)])
    doc, term = np.nonzero(rng.random((docs, terms)) < 0.2)
    repeats = rng.integers(1, 6, len(doc))
    n = rng.integers(20, 900, docs)
    known.weigh(docs, int(n.sum()), np.bincount(term, minlength=terms))
    made = make_block(pa.array(np.arange(docs)), n, doc, term, repeats, known)
    return Block(made | {"doc_keys": np.arange(docs)}, known), doc, term


def test_pair_lists_hold_joint_maxima():
    block, doc, term = block_of(np.random.default_rng(2), 200, 12)
    made, known = block.made, block.known
    impact = {}
    for t, a, b in zip(made["terms"], made["term_starts"], made["term_starts"][1:]):
        for d, r in zip(made["term_docs"][a:b], made["term_rates"][a:b]):
            impact[int(t), int(d)] = int(known.weights[t]) * int(r)
    assert len(impact) == len(doc)
    for i, p in enumerate(made["pairs"]):
        a, b = known.pairs[p].tolist()
        both = [d for d in range(200) if (a, d) in impact and (b, d) in impact]
        part = made["pair_docs"][made["pair_starts"][i] : made["pair_starts"][i + 1]]
        assert sorted(part.tolist()) == both
        assert made["pair_best"][i] == max(impact[a, d] + impact[b, d] for d in both)


def test_pairs_tighten_the_bounds_and_keep_the_result():
    fewer = 0
    for seed in range(6):
        block, _, _ = block_of(np.random.default_rng(seed), 3000, 14)
        with_pairs, single = Best.none(10), Best.none(10)
        block.search(0, with_pairs)
        block.search(0, single, pairs=False)
        assert with_pairs.keys.tolist() == single.keys.tolist()
        assert with_pairs.scores.tolist() == single.scores.tolist()
        # A second look knows the k-th score, as a later block does.
        again = {}
        for pairs, best in ((True, with_pairs), (False, single)):
            units = block.units(0, pairs)
            again[pairs] = sum(bound for bound, _ in units)
            best.scored = 0
            block.search(0, best, pairs)
        assert again[True] < again[False]
        fewer += single.scored - with_pairs.scored
    assert fewer >= 0
