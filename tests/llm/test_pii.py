import random
import re

import numpy as np
import pytest

from rainfold.llm import pii
from rainfold.llm.bilstm_crf import Tagger, allowed, best_paths
from tests.llm.conftest import prose

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in match.group().split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, match.start(), match.end()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    for alphabet in ("a1@.-+ ", "12.", "0123456789 -", "+12() .-", "aZ_%@.é\n9"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
            assert pii.base_spans(text) == plain_spans(text), text
    card = "4541 3648-5993 4786"
    assert [s[0] for s in pii.base_spans(f"x {card} 300.1.1.1 0255.00.01.1 ")] == ["ip", "card"]


def test_base_spans_are_linear():
    for text in ("1" * 2_000_000, "a" * 2_000_000 + "@", "a@" + "b" * 2_000_000, "1." * 900_000,
                 "@a.b" * 400_000, "+1" + " " * 2_000_000, "a" * 1_000_000 + "@b." * 9):
        pii.base_spans(text)


def shapes(rng):
    digits = lambda n: "".join(str(rng.randrange(10)) for _ in range(n))
    body = "4" + digits(14)
    card = next(body + str(c) for c in range(10) if luhn(body + str(c)))
    return rng.choice(
        [
            f"{prose(rng.randrange(999), 1)}.{digits(2)}@mail{digits(1)}.example.com",
            ".".join(str(rng.randrange(256)) for _ in range(4)),
            card,
            f"+1 ({digits(3)}) 555-{digits(4)}",
            f"token = {digits(9)}ab{digits(8)}",
            f"on {digits(2)}.{digits(2)}.{digits(4)}",
        ]
    )


def text_of(seed, spans=2):
    rng = random.Random(seed)
    parts = [re.sub("[0-9]", "", prose(seed + i, 30)) for i in range(spans + 1)]
    out = parts[0]
    for part in parts[1:]:
        out += " " + shapes(rng) + " " + part
    return out


@pytest.fixture(scope="module")
def tagger(spark, documents):
    return pii.fit(documents(*[(i, text_of(i)) for i in range(900)]))


def test_tagger_on_held_out_texts(tagger):
    texts = [text_of(50_000 + i) for i in range(200)]
    missed = total = 0
    for text, found in zip(texts, pii.tagged(texts, tagger)):
        base = set(pii.base_spans(text))
        total += len(base)
        missed += len(base - {s[:3] for s in found})
        assert not pii.added_spans(text, sorted(base), found)
    assert total > 200 and missed < 0.05 * total


def test_tagger_adds_what_the_patterns_miss(tagger):
    rng, hit = random.Random(2), 0
    for i in range(60):
        name = prose(i, 1)
        before, after = (re.sub("[0-9]", "", prose(i + k, 25)) for k in (900, 990))
        digits = "".join(str(rng.randrange(10)) for _ in range(3))
        hidden = rng.choice([f"{name} @ mail7.example.com", f"({digits}) 555-{digits}4"])
        text = f"{before} {hidden} {after}"
        assert not pii.base_spans(text)
        added = pii.added_spans(text, [], pii.tagged([text], tagger)[0])
        hit += any(a < text.index(hidden) + len(hidden) and b > text.index(hidden) for _, a, b in added)
    assert hit >= 45


def test_rows(spark, documents, tagger):
    long = "é" * 30_000 + " write to ana.b@mail.example.com " + prose(1, 9000)
    docs = documents((1, None), (2, ""), (3, "no data here"), (4, long), (4, "call +1 (499) 555-6503"),
                     (None, "10.0.0.1"), (5, "7" * 3000), extra=["spans", "kind"])
    rows = pii.personal_data(docs, tagger).collect()
    found = {(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans if s.base)) for r in rows}
    assert len(rows) == 7
    assert found == {
        (1, ()), (2, ()), (3, ()), (5, ()), (None, (("ip", 0, 8),)), (4, (("phone", 5, 22),)),
        (4, (("email", 30_010, 30_032),)),
    }
    assert pii.fit(docs.where("doc_id = 3")) is None
    assert pii.fit(docs.where("false")) is None
    base_only = pii.personal_data(docs, None).collect()
    assert [len(r.spans) for r in base_only].count(1) == 3


def test_regions_are_covered_by_overlapping_windows():
    text = "x" * 50 + "1" + "x" * 300 + "@2" * 200 + "x" * 9
    for start, end in pii.regions(text):
        covered = np.zeros(end - start, int)
        for w in pii.windows_of(start, end):
            covered[max(0, w - start) : max(0, w + pii.WINDOW - start)] += 1
        assert covered.min() >= 1 and (end - start <= pii.WINDOW or covered[50:-50].min() >= 2)


def test_best_paths_equal_trying_all():
    rng = np.random.default_rng(1)
    may = allowed(1)
    scores = rng.normal(size=(5, 6, 3))
    lengths = np.array([6, 1, 4, 5, 2])
    paths = best_paths(scores, lengths, may)
    for row, n, path in zip(scores, lengths, paths):
        ways = [p for p in np.ndindex(*[3] * n) if all(may[a, b] for a, b in zip(p, p[1:]))]
        best = max(ways, key=lambda p: sum(row[t, k] for t, k in enumerate(p)))
        assert tuple(path[:n]) == best


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    tagger = Tagger(2)
    tagger.weights = {k: w.astype(float) for k, w in tagger.weights.items()}
    ids = rng.integers(0, 98, (3, 7)).astype(np.uint8)
    tags = np.array([[0, 1, 2, 2, 0, 3, 4], [0, 0, 0, 1, 2, 0, 0], [3, 4, 4, 0, 1, 1, 0]])
    _, gradients = tagger.loss_and_gradients(ids, tags)
    for name, weights in tagger.weights.items():
        at = (int(ids[0, 2]), 1) if name == "vectors" else tuple(0 for _ in weights.shape)
        kept, sides = weights[at], []
        for step in (1e-3, -1e-3):
            weights[at] = kept + step
            sides.append(tagger.loss_and_gradients(ids, tags)[0])
        weights[at] = kept
        assert abs((sides[0] - sides[1]) / 2e-3 - gradients[name][at]) < 1e-3
