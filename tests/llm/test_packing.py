import random
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

from rainfold.llm import cutting_stock
from rainfold.llm.packing import pack
from rainfold.llm.tokens import ids_of
from tests.llm.conftest import prose

FILE = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_equal_the_library():
    exact = Tokenizer.from_file(FILE)
    texts = ["", " ", "a\x85b", "a\xa0\xa0b", "it's  x\n\n y", "日本 é", "<|endoftext|> a", "²½ ªº µ"]
    texts += [c + "a" + c + c + "1" for c in map(chr, range(256))]
    texts += [prose(1, 400), "Grün für\tÄrger.\n" * 50]
    for text in texts:
        assert ids_of(FILE)(text) == exact.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_token_lies_in_one_piece(documents):
    rows = [(i, prose(i, 20 + 37 * i % 900)) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "null id"), (3, rows[3][1]), (3, "same id"),
             (102, prose(1, 20_000))]
    docs = documents(*rows, extra=["start", "size"])
    found = pack(docs, FILE, with_ids=True).collect()
    exact = Tokenizer.from_file(FILE)
    wanted = Counter()
    for i, text in rows:
        ids = exact.encode(text or "", add_special_tokens=False).ids + [1]
        for start in range(0, len(ids), 2048):
            piece = ids[start : start + 2048]
            wanted[i, start, len(piece), zlib.crc32(array("I", piece)), len(ids)] += 1
    assert wanted == Counter(
        (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found
    )
    assert all(zlib.crc32(array("I", r.ids)) == r.ids_crc32 for r in found)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) * 2048 <= 1.08 * sum(r.length for r in found)


def test_empty_table(documents):
    assert pack(documents((1, "x")).where("false"), FILE).count() == 0


def test_patterns_hold_every_size():
    rng = random.Random(4)
    for n in (0, 1, 2, 30, 500, 5000):
        demand = Counter(min(64, 1 + int(rng.expovariate(0.05))) for _ in range(n))
        mix = cutting_stock.solve(dict(demand), 64)
        taken = cutting_stock.rounded(mix, dict(demand), 64)
        held = Counter()
        for pattern, times in taken:
            assert sum(size * k for size, k in pattern.items()) <= 64
            for size, k in pattern.items():
                held[size] += k * times
        assert held == demand
        if n == 5000:
            bins, least = sum(t for _, t in taken), sum(s * k for s, k in demand.items()) / 64
            assert bins <= 1.01 * least + 1


def test_best_pattern_equals_trying_all():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = np.sort(rng.choice(np.arange(2, 12), 4, replace=False))
        prices = rng.uniform(0, 1, 4)
        best = max(
            sum(k * p for k, p in zip(ks, prices))
            for ks in itertools.product(*(range(20 // s + 1) for s in sizes))
            if sum(k * s for k, s in zip(ks, sizes)) <= 20
        )
        worth, pattern = cutting_stock.best_pattern(sizes, prices, 20)
        assert abs(worth - best) < 1e-9
        assert sum(s * k for s, k in pattern.items()) <= 20
