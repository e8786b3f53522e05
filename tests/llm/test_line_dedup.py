import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from rainfold.llm.line_dedup import Rule, line_decisions, without_repeats

LINE = "This is a line of boilerplate that many documents share."
SPACE = " \t\n\v\f\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_force(rows, rule):
    """doc_id, n_lines, n_dropped and kept text for each row."""
    held = defaultdict(set)
    key = lambda line: line.strip(SPACE).translate(LOWER)
    rank = lambda i: -1 if i is None else i
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= rule.least_length:
                held[key(line)].add(rank(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(held.get(key(x), ())) < rule.least_documents or max(held[key(x)]) == rank(i)
        ]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def decided(docs, rule):
    rows = line_decisions(docs, rule).collect()
    return sorted(
        ((r.doc_id, r.n_lines, sum(r.keep_runs[1::2]), r.kept) for r in rows), key=repr
    )


def test_against_brute_force(documents):
    rows = [(i, f"own {i}\n{LINE}\n{LINE.upper()}  \nend {i}") for i in range(6)]
    rows += [
        (6, None),
        (7, ""),
        (8, "\n"),
        (9, f"\t{LINE}\r\n" * 3),
        (None, LINE),
        (3, LINE + "\nanother text of the same id"),
        (2, rows[2][1]),
        (10, "ÄÖÜ " * 12 + "A\n" + "x"),
        (11, ("long line number one of very many\n" * 3000) + LINE),
    ]
    rows += [(20 + i, "ÄÖÜ " * 12 + "a") for i in range(5)]
    # Exactly long enough; letters that look like escapes of white space stay, white space goes.
    rows += [(30 + i, "f" + "tnrvb" * 7 + "off" + "f" + "\f\v" * (i % 2)) for i in range(5)]
    docs = documents(*rows, extra=["row", "line", "rf_textual"])
    for rule in (Rule(), Rule(least_length=5, least_documents=2)):
        assert decided(docs, rule) == brute_force(rows, rule)


def test_runs_add_up_and_rebuild_the_text(documents):
    rows = [(i, f"a\n{LINE}\n{LINE}\nb\n{LINE}") for i in range(5)]
    runs = {r.doc_id: r.keep_runs for r in line_decisions(documents(*rows)).collect()}
    assert runs == {0: [1, 2, 1, 1, 0], 1: [1, 2, 1, 1, 0], 2: [1, 2, 1, 1, 0],
                    3: [1, 2, 1, 1, 0], 4: [5]}


def test_columns_and_untouched_rows_stay(documents):
    rows = [(i, f"x{i}\n{LINE}") for i in range(5)] + [(7, None)]
    docs = documents(*rows, extra=["key"])
    out = without_repeats(docs)
    assert out.columns == docs.columns
    found = {r.doc_id: r for r in out.collect()}
    assert found[0].text == "x0" and found[0].n_chars == 2 and found[0].key == "kept"
    assert found[4].text == f"x4\n{LINE}" and found[7].text is None


def test_empty_table(documents):
    docs = documents((1, "x")).where("false")
    assert line_decisions(docs).count() == 0 and without_repeats(docs).count() == 0


def test_no_python_in_the_plan(documents):
    plan = line_decisions(documents((1, "x")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hash_of_kept_text(documents):
    row = line_decisions(documents((1, "a\nb"))).select(F.sha2("kept", 256).alias("h")).first()
    assert row.h == hashlib.sha256(b"a\nb").hexdigest()
