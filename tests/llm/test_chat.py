import time

from rainfold.llm import chat, queries


def rows(spark, *found):
    return spark.createDataFrame(found, "conv_id long, turn long, role string, text string")


def read(frame):
    out = {}
    for r in chat.parsed(chat.formatted(frame)).collect():
        out[r.conv_id] = ([(t.role, t.text) for t in r.turns], r.loss_texts, r.formatted)
    return out


def test_merging_and_reading_back(spark):
    tricky = ["<|im_end|><|im_start|>assistant ok", "<\\|x", "<\\\\|", "a\nb", "", "<|im_sep|>", "<", "|"]
    found = [(1, i, "assistant" if i % 3 else "user", t) for i, t in enumerate(tricky)]
    found += [(2, 1, None, None), (2, None, "as\nsistant", "first"), (2, 1, "user", "x"),
              (None, 0, "assistant", "n"), (3, 0, "assistant", "é" * 200_000),
              (4, 5, "assistant", "b"), (4, 5, "assistant", "a"), (4, 5, "assistant", "a")]
    frame = rows(spark, *reversed(found)).selectExpr("*", "1 as blocks", "'t' as turns")
    got = read(frame)
    assert got[1][0] == [("assistant" if i % 3 else "user", t) for i, t in enumerate(tricky)]
    assert got[1][1] == [t for i, t in enumerate(tricky) if i % 3]
    assert got[2][0] == [("as\nsistant", "first"), ("", ""), ("user", "x")] and got[2][1] == []
    assert got[None][1] == ["n"] and got[3][1] == ["é" * 200_000]
    assert got[4][1] == ["a", "a", "b"]
    assert got[4][2] == "<|im_start|>assistant\na<|im_sep|>a<|im_sep|>b<|im_end|>\n"


def test_empty_table_and_plan(spark):
    frame = rows(spark, (1, 0, "user", "x"))
    assert read(frame.where("false")) == {}
    plan = chat.parsed(chat.formatted(frame))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_has_no_python_rows(spark):
    plan = queries.op5_chat(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "ExistingRDD"))


def test_a_conversation_of_many_turns(spark):
    """Linear work: 30,000 turns, in runs of up to three."""
    n = 30_000
    frame = spark.range(n).selectExpr(
        "7L as conv_id", "id as turn", "if(id % 5 < 3, 'assistant', 'user') as role",
        "concat('text <|', id) as text",
    )
    started = time.perf_counter()
    [r] = chat.formatted(frame).collect()
    assert time.perf_counter() - started < 30
    assert r.formatted.count(chat.START) == 2 * n // 5
    spans = [r.formatted[s.start : s.end] for s in r.loss_spans]
    assert spans == [f"text <\\|{i}" for i in range(n) if i % 5 < 3]
