import numpy as np
import pyarrow as pa

from rainfold.llm import hashing

TEXTS = ["The cat  sat\ton the Mat", None, "", "the CAT", "x" * 2_500_000 + " y z", " \n ", "é É"]


def expected(text):
    return (text or "").encode().lower().split()


def test_words_and_hashes_agree_with_bytes():
    words, _, _ = hashing.words_of(pa.array(TEXTS))
    wanted = [w for t in TEXTS for w in expected(t)]
    assert words.counts().tolist() == [len(expected(t)) for t in TEXTS]
    by_word = {}
    for word, value in zip(wanted, words.hashes.tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_a_word_hashes_alike_anywhere():
    long = "ab " * 700_000 + "needle " + "cd " * 10
    words, _, _ = hashing.words_of(pa.array([long, "needle"]))
    assert words.hashes[700_000] == words.hashes[-1]


def test_slices_of_a_column():
    column = pa.array(["skip", "one two", "three"])[1:]
    words, _, _ = hashing.words_of(column)
    assert words.counts().tolist() == [2, 1]


def test_short_texts_have_one_shingle():
    words, _, _ = hashing.words_of(pa.array(["a b c d e", "a b", "", "a b c", "a b c d"]))
    shingles, bounds = hashing.shingles_of(words, 4)
    assert np.diff(bounds).tolist() == [2, 1, 0, 1, 1]
    assert shingles[0] == shingles[4]
    assert len(set(shingles.tolist())) == 4


def test_sequences_depend_on_order():
    words, _, _ = hashing.words_of(pa.array(["a b", "b a", "A  B", "a b a"]))
    low, high = hashing.sequence_hashes(words)
    assert low[0] == low[2] and high[0] == high[2]
    assert len(set(low.tolist())) == 3 and len(set(high.tolist())) == 3


def test_pieces_cover_all_rows():
    column = pa.array(["a" * 10, None, "b" * 50, "", "c"])
    assert list(hashing.pieces_of(column, 20)) == [(0, 2), (2, 3), (3, 5)]
    assert list(hashing.pieces_of(pa.array([], pa.string()))) == []
