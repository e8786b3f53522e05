import numpy as np
import pyarrow as pa

from rainfold.llm import quality
from tests.llm.conftest import prose


def test_pairs_by_the_identity():
    rng = np.random.default_rng(0)
    machine = quality.Machine(
        0.3,
        rng.normal(size=quality.FEATURES).astype(np.float32),
        rng.normal(size=(quality.RANK, quality.FEATURES)).astype(np.float32),
    )
    numbers, values, bounds = quality.features(pa.array(["a b a c", None, ""]), np.array([7, -1, 0]))
    raw = machine.raw(numbers, values, bounds)
    for row, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        n, x = numbers[a:b], values[a:b].astype(float)
        total = 0.3 + (machine.weights[n] * x).sum()
        for i in range(len(n)):
            for j in range(i):
                total += machine.vectors[:, n[i]] @ machine.vectors[:, n[j]] * x[i] * x[j]
        assert abs(total - raw[row]) < 1e-3 * max(1, abs(total))


def test_held_out_rows(spark, documents):
    def junk(i):
        return (f"word{i % 7} " * 60) if i % 2 else prose(i, 50).upper().replace(" ", "!! ")

    rows = [(i, junk(i) if i % 3 == 0 else prose(i, 60)) for i in range(300)]
    docs = documents(*rows, (1000, None), (1001, ""), (1002, prose(1, 50_000)), (None, "x"),
                     extra=["recorded", "label"])
    labels = spark.createDataFrame(
        [(i, int(i % 3 != 0)) for i in range(240)] + [(1000, None), (None, 1)],
        "doc_id long, quality int",
    )
    machine = quality.fit(docs, labels, "quality")
    found = [(r.doc_id, r.score) for r in quality.scores(docs, machine).collect()]
    assert len(found) == 304 and all(0 <= s <= 1 for _, s in found)
    right = [(s >= 0.5) == (i % 3 != 0) for i, s in found if i is not None and 240 <= i < 300]
    assert sum(right) >= 57
    one_label = quality.fit(docs, labels.where("quality = 1"), "quality")
    assert quality.scores(docs.limit(1), one_label).first().score > 0.99
    assert quality.fit(docs, labels.where("false"), "quality").bias == 0
    assert quality.scores(docs.where("false"), machine).count() == 0
