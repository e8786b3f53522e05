import numpy as np
from pyspark.sql import functions as F

from rainfold.llm import toxicity
from tests.llm.conftest import prose


def labelled(spark, bad_word, n=80):
    rows = [(prose(i, 30) + (f" {bad_word}, " if i % 4 == 0 else " ") + prose(i + 500, 20),
             int(i % 4 == 0)) for i in range(n)]
    return spark.createDataFrame(rows + [(None, 0), ("", 0), ("x", None)], "text string, label int")


def scores(spark, model, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = frame.select("i", toxicity.score(F.col("text"), model).alias("s")).collect()
    return [r.s for r in sorted(rows)]


def test_hidden_words_score_like_plain_ones(spark, documents):
    rows = labelled(spark, "gromble")
    model = toxicity.fit(rows, rows)
    clean = prose(9000, 40)
    texts = [clean, clean + " gromble", clean + " gr0mble", clean + " g r o m b l e",
             clean + " grommmmble", None, "", "." * 1000, "a" * 300_000, "$" * 100_000]
    found = scores(spark, model, texts)
    assert min(found[1:5]) > 0.7 and found[0] < 0.3
    assert found[5] == found[6] and all(0 <= s <= 1 for s in found)
    assert found[0] == scores(spark, model, [clean])[0]


def test_no_labels_and_empty_tables(spark, documents):
    rows = labelled(spark, "gromble")
    for some in (rows.where("false"), rows.where("label = 0")):
        assert scores(spark, toxicity.fit(rows, some), ["gromble"])[0] < 1e-9
    empty = rows.where("false")
    assert scores(spark, toxicity.fit(empty, empty), ["a"])[0] < 1e-9


def brute_force(model, written):
    """The best reading by trying all."""
    readings = [("", 0.0)]
    for c in written:
        options = [(c, 0.0)] if c not in toxicity.LOOKALIKES else []
        options += [(x, toxicity._CHANGED) for x in toxicity.LOOKALIKES.get(c, "")]
        readings = [(t + x, p + q) for t, p in readings for x, q in options]

    def total(text, p):
        codes = [0, 0] + [toxicity._CODE.get(c, toxicity._OTHER) for c in text] + [0]
        return p + sum(model.log[a][b][c] for a, b, c in zip(codes, codes[1:], codes[2:]))

    return max(total(t, p) for t, p in readings), total


def test_viterbi_finds_the_best_reading():
    counts = np.random.default_rng(1).integers(0, 50, toxicity._SIZE**3)
    model = toxicity.CharacterModel(counts)
    for written in ("1d10t", "$7up1d", "w0r7hl3$5", "!a|", "abc", "l1", "+1+0"):
        best, total = brute_force(model, written)
        reading = model.decode(written)
        changed = sum(a in toxicity.LOOKALIKES for a in written) * toxicity._CHANGED
        assert abs(total(reading, changed) - best) < 1e-9


def test_counts_cover_all_documents(spark, documents):
    docs = documents((1, "ab"), (2, "ab"), (3, None), (4, "A B"))
    counts = toxicity.count_characters(docs).reshape((toxicity._SIZE,) * 3)
    a, b = toxicity._CODE["a"], toxicity._CODE["b"]
    assert counts[0, a, b] >= 2 and counts[0, 0, a] >= 1
