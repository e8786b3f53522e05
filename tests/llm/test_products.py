import numpy as np
import pytest

from rainfold.llm import products


def all_pairs(asked, rows, least):
    scores = np.array([[sum(map(int.__mul__, a, b)) for b in rows.tolist()] for a in asked.tolist()])
    return scores, {(i, x, int(scores[i, x])) for i, x in zip(*np.nonzero(scores >= least[:, None]))}


def search(asked, rows, least):
    search = products.Search(products.Vectors(products.smallest(asked)))
    found = search.reaching(np.arange(len(asked)), least, products.Vectors(products.smallest(rows)))
    return set(zip(*(c.tolist() for c in found[:3]))), set(found[3].tolist())


@pytest.mark.parametrize(
    "width, size, rank", [(64, 30, 2), (64, 3000, 2), (3, 2**26, 2), (1, 5, 9), (20, 2**20, 40)]
)
def test_against_all_pairs(width, size, rank):
    rng = np.random.default_rng(width)
    asked = np.rint(rng.normal(0, size, (51, width))).astype(np.int64)
    rows = np.rint(rng.normal(0, size, (1500, width))).astype(np.int64)
    rows[9] = asked[3] = 0
    scores, _ = all_pairs(asked, rows, np.zeros(51, np.int64))
    least = np.sort(scores, axis=1)[:, -rank]
    least[7], least[8] = products.LOWEST, 2**62
    found, many = search(asked, rows, least)
    assert 7 in many
    wanted = all_pairs(asked, rows, least)[1]
    assert found == {pair for pair in wanted if pair[0] not in many}

