import hashlib
import random

from rainfold.llm import warc

BIG = "<p>" + "grün " * 40 + "</p>"


def pages(spark, *rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_round_trip(spark, tmp_path):
    rows = [(3, "http://b.org/x?q=1", BIG), (1, "https://www.b.org/x", BIG), (2, None, None),
            (4, "http://a.org/\r\nEvil: 1", "WARC/1.0\r\n\r\n\r\n\r\nWARC-Type: fake" * 9),
            (5, "http://a.org", "small"), (6, "http://a.org", "small"), (None, "http://a.org/n", BIG),
            (7, "http://a.org/long", "x" * 3_000_000), (3, "http://b.org/x?q=1", BIG)]
    table = pages(spark, *rows).selectExpr("*", "'x' as digest", "1 as size")
    found = warc.archived(table, str(tmp_path / "warc")).collect()
    assert len(found) == len(rows)
    wanted = sorted(
        (
            (i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(),
             "revisit" if h == BIG and i not in (1, None) else "response",
             1 if h == BIG and i not in (1, None) else None)
            for i, _, h in rows
        ),
        key=repr,
    )
    got = [
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found
    ]
    assert sorted(got, key=repr) == wanted
    ordered = sorted(found, key=lambda r: (r.range_id, r.place))
    keys = [(r.url_key, r.captured, -1 if r.page_id is None else r.page_id) for r in ordered]
    assert keys == sorted(keys)


def test_empty_table(spark, tmp_path):
    empty = pages(spark, (1, "u", "h")).where("false")
    assert warc.archived(empty, str(tmp_path / "none")).count() == 0


def test_url_keys():
    assert warc.url_key("HTTPS://www.Example.com/A?b=1#top") == "com,example)/a?b=1"
    assert warc.url_key("http://example.com") == "com,example)/"
    assert warc.url_key("") == ")/"
    assert warc.url_key("http://[broken") == "http://[broken"


def test_loser_tree_equals_sorting():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((rng.randrange(20), i) for _ in range(rng.randrange(9))) for i in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for run in runs for x in run)
