from rainfold.llm import decontamination
from rainfold.llm.decontamination import Index, Rule, contaminated, questions_and_answers
from tests.llm.conftest import prose

ITEM = "Which of the seven rivers crosses the old town before noon? The river Alba does so."


def items(spark, *rows):
    return questions_and_answers(spark.createDataFrame(rows, "item_id long, text string"))


def test_questions_and_answers(spark):
    rows = [(1, ITEM), (2, "one two three four"), (3, None), (4, "")]
    found = {r.item_id: (r.question, r.answer) for r in items(spark, *rows).collect()}
    assert found[1] == (ITEM[:59], ITEM[60:])
    assert found[2] == ("one two", "three four")
    assert found[3] == ("", "") == found[4]


def test_hidden_items_are_found_and_clean_documents_stay(spark, documents):
    other = prose(5, 40)
    bench = items(spark, (1, ITEM), (2, other), (3, "too short"), (4, None), (1, ITEM))
    question_only = ITEM[:59]
    docs = documents(
        (1, prose(1, 900) + " " + ITEM + " " + prose(2, 700)),
        (2, prose(3, 500)),
        (3, ITEM.upper().replace(" ", "\n")),
        (4, None),
        (5, ""),
        (6, prose(4, 300) + " " + question_only + " " + prose(6, 300)),
        (7, other.replace(other.split()[20], "changed") + " tail"),
        (8, prose(8, 60_000) + other),
        (None, ITEM),
        (1, ITEM),
        extra=["item_id", "score"],
    )
    found = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    assert found == {(1, 1), (3, 1), (None, 1), (7, 2), (8, 2)}
    left = decontamination.without_contaminated(docs, bench)
    assert left.columns == docs.columns
    # The row with a null id holds an item as well.
    assert sorted(r.doc_id for r in left.collect()) == [2, 4, 5, 6]


def test_empty_tables(spark, documents):
    bench = items(spark, (1, ITEM))
    docs = documents((1, ITEM))
    assert contaminated(docs.where("false"), bench).count() == 0
    assert contaminated(docs, bench.where("false")).count() == 0


def test_several_shards(spark, documents, monkeypatch):
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 400)
    texts = [prose(50 + i, 20) for i in range(12)]
    bench = items(spark, *enumerate(texts))
    docs = documents(*[(i, prose(200 + i, 90) + " " + t) for i, t in enumerate(texts)])
    found = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    assert found == {(i, i) for i in range(12)}


def test_search_equals_scoring_every_item():
    texts = [prose(i % 37, 10 + i % 30) for i in range(120)]
    index = Index([(i, t, "end of it") for i, t in enumerate(texts)], Rule(score=0.3))
    number = {t: i for i, t in enumerate(range(len(index.terms)))}
    for seed in range(40):
        terms = sorted({(seed * 31 + k * 7) % len(index.terms) for k in range(60)} | {0, 1})
        score = {}
        for t in terms:
            for item, impact in zip(index.items_of[t], index.impacts_of[t]):
                score[item] = score.get(item, 0) + impact
        wanted = {i for i, s in score.items() if s >= 0.3 - 1e-9}
        assert {i for i, _ in index.search([number[t] for t in terms])} == wanted


def test_short_items_follow_the_same_rule(spark, documents):
    """Half of the pairs of words that touch the question, and half of those that touch the answer."""
    bench = items(spark, (1, ITEM), (2, "Who rules? Queen Ama."), (3, "Alba"), (4, ""), (5, None),
                  (6, "who rules QUEEN ama"))
    docs = documents(
        (1, prose(1, 300) + " who rules: queen Ama, " + prose(2, 300)),
        (2, prose(3, 50) + " who rules the queen Ama " + prose(4, 50)),
        (3, "Who rules? Queen Ama"), (4, "Who rules? Queen"), (5, "Ama"), (6, "to alba."), (7, ""),
        (8, None), (9, ITEM), (10, "Ama rules, who Queen?"), (11, "who rules here"),
    )
    found = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    assert found == {(d, i) for d in (1, 2, 3, 4) for i in (2, 6)} | {(6, 3), (9, 1), (9, 3)}
    alone = {(r.doc_id, r.item_id) for r in contaminated(docs, bench.where("item_id = 3")).collect()}
    assert alone == {(6, 3), (9, 3)}


def test_repeated_ids_are_decided_by_their_own_text(spark, documents):
    bench = items(spark, (1, ITEM))
    docs = documents((1, ITEM), (1, "a clean text"), (1, None), (2, "x " + ITEM), (3, "x"), extra=["a", "b"])
    left = decontamination.without_contaminated(docs, bench)
    assert left.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    assert found == [(1, "a clean text"), (1, None), (3, "x")]


def test_a_null_id_is_decided_by_its_own_text(spark, documents):
    bench = items(spark, (1, ITEM))
    docs = documents((None, ITEM), (None, "a clean text"), (None, None), (None, "x " + ITEM))
    left = decontamination.without_contaminated(docs, bench).collect()
    assert sorted((r.text for r in left), key=repr) == ["a clean text", None]
