import random

from rainfold.llm import components, near_dedup
from rainfold.llm.near_dedup import Rule, drop_near_duplicates, near_duplicates
from tests.llm.conftest import prose


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_force(rows, rule):
    sets = {i: shingles(t, rule.shingle) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= rule.percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def edited(text, seed, edits):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def test_against_brute_force(spark, documents):
    rows = [(i, prose(i, 60 + i)) for i in range(20)]
    base = prose(100, 150)
    rows += [(100 + i, edited(base, i, i % 6)) for i in range(60)]  # some are near the base alone
    rows += [(200 + i, base.upper()) for i in range(40)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, "Two words"), (304, "two  WORDS"),
             (305, "a b c d"), (306, "a b c d e"), (307, prose(7, 30_000)),
             (308, edited(prose(7, 30_000), 1, 100))]
    docs = documents(*rows, extra=["node", "signature"])
    rule = Rule(shingle=4, percent=80)
    assert sorted(tuple(r) for r in near_duplicates(docs, rule).collect()) == brute_force(rows, rule)


def test_null_and_repeated_ids(documents):
    a, b = prose(1, 80), prose(2, 80)
    rows = [(None, a), (None, a), (5, a), (5, a), (3, b), (4, b), (9, a)]
    found = sorted(
        ((r.doc_id, r.component_id, r.kept) for r in near_duplicates(documents(*rows)).collect()),
        key=repr,
    )
    assert found == sorted(
        [(None, None, True)] * 2
        + [(5, 5, True)] * 2 + [(3, 3, True), (4, 3, False), (9, 5, False)],
        key=repr,
    )


def test_each_text_of_a_repeated_id_is_searched(documents):
    texts = [prose(40 + i, 90) for i in range(4)]
    near = [edited(t, 9, 1) for t in texts]
    # 5 joins what is near to any of its texts; 20 and 21 share one more text with each other.
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[2]), (9, texts[1]), (12, near[1]), (3, near[2]),
            (30, near[0]), (20, texts[3]), (21, texts[3]), (20, prose(77, 50)), (5, "")]
    found = {(r.doc_id, r.n_shingles > 0, r.component_id) for r in near_duplicates(documents(*rows)).collect()}
    assert found == {(i, True, 3) for i in (3, 5, 9, 12, 30)} | {
        (20, True, 20), (21, True, 20), (5, False, 5),
    }


def test_stage_keeps_one_of_each_group(documents):
    a = prose(1, 80)
    docs = documents((4, a), (2, a), (7, edited(a, 1, 1)), (8, prose(2, 80)), (None, a), (9, None))
    out = drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id for r in out.collect()), key=repr) == [2, 8, 9, None]


def test_empty_table(documents):
    assert near_duplicates(documents((1, "x")).where("false")).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(40)] + [(7, 7)]
    found = components.connected(spark.createDataFrame(links, "a long, b long").repartition(4))
    got = dict(tuple(r) for r in found.collect())
    assert got == {i: 0 for i in range(61)} | {100: 100} | {200 + i: 100 for i in range(40)}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def star(start, copies, edits, words=150):
    """An origin and copies with edits far from each other: near to the origin, not to one another."""
    origin, rows = prose(start, words), [(start, prose(start, words))]
    for i in range(copies):
        text, rng = origin.split(), random.Random(start + i)
        gap = words // edits
        for k in range(edits):
            text[k * gap + rng.randrange(2, gap - 2)] = f"edit{start}x{i}x{k}"
        rows.append((start + 1 + i, " ".join(text)))
    return rows


def test_large_stars_around_one_origin(documents):
    rows = star(10_000, 3_000, 3) + star(20_000, 400, 4)
    rule = Rule(shingle=4, percent=80)
    for i, edits in ((10_000, 3), (20_000, 4)):
        sets = [shingles(dict(rows)[i + k], 4) for k in range(3)]
        assert 100 * len(sets[0] & sets[1]) >= 80 * len(sets[0] | sets[1])
        assert edits == 3 or 100 * len(sets[1] & sets[2]) < 80 * len(sets[1] | sets[2])
    found = near_duplicates(documents(*rows), rule).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(i, i // 10_000 * 10_000) for i, _ in rows}


def test_links_the_forest_does_not_see(documents, monkeypatch):
    """The exact completion alone: no pairs from the forest, and all nodes crowded."""
    forest = near_dedup.candidates

    def blind(nodes, paths):
        return forest(nodes, paths)[0].where("false"), nodes.select("node")

    monkeypatch.setattr(near_dedup, "candidates", blind)
    rows = [(i, prose(i, 60 + i)) for i in range(20)] + star(100, 30, 4, 160)
    rows += [(200 + i, edited(prose(7, 40), i, i)) for i in range(8)]
    rows += [(300, "one two"), (301, "a b c d e f g h i j"), (302, "a b c d e f g h i j k")]
    for size, percent in ((4, 80), (3, 67), (2, 100)):
        rule = Rule(shingle=size, percent=percent)
        found = near_duplicates(documents(*rows), rule).collect()
        assert sorted(tuple(r) for r in found) == brute_force(rows, rule)
