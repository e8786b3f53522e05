import gzip
import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from rainfold.plans.facts import dim_locations
from rainfold.sources.landing import malformed_lines, read_landing, require_landing, write_landing
from rainfold.sources.locations import active_locations, read_locations
from tests.helpers import records

HEADER = "location_id,name,state,country,latitude,longitude,timezone,is_active"


@pytest.fixture
def csv(tmp_path):
    def write(*lines, header=HEADER):
        path = tmp_path / "locations.csv"
        path.write_text("\n".join([header, *lines]))
        return str(path)

    return write


def test_columns_match_by_name(spark, csv):
    path = csv(
        "true,a,UTC,A,S,X,1.5,2.5",
        header="is_active,location_id,timezone,name,state,country,latitude,longitude",
    )
    row = read_locations(spark, path).first()
    assert (row["location_id"], row["latitude"], row["is_active"]) == ("a", 1.5, "true")


def test_missing_file_and_columns(spark, csv, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_locations(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError, match=r"\['latitude', 'state'\]"):
        read_locations(
            spark, csv(header="location_id,name,country,longitude,timezone,is_active")
        )


def test_active_rows_only(spark, csv):
    path = csv("a,A,S,X,1,2,UTC,Yes", "b,B,S,X,,,UTC,no", "c,C,S,X,3,4,UTC,")
    locations = read_locations(spark, path)
    assert records(active_locations(locations), "location_id", "is_active") == [("a", True)]


def test_dimension_keeps_inactive_and_unknown(spark, csv):
    path = csv("a,A,S,X,1,2,UTC,Yes", "b,B,S,X,,,UTC,no", "c,C,S,X,3,4,UTC,")
    dim = dim_locations(read_locations(spark, path))
    assert records(dim, "location_id", "location_name", "is_active") == [
        ("a", "A", True), ("b", "B", False), ("c", "C", None)]


def test_no_active_row_is_an_error(spark, csv):
    with pytest.raises(ValueError, match="no active location"):
        active_locations(read_locations(spark, csv("a,A,S,X,1,2,UTC,no")))


def test_active_row_needs_coordinates(spark, csv):
    with pytest.raises(ValueError, match="latitude or longitude"):
        active_locations(read_locations(spark, csv("a,A,S,X,1,,UTC,1")))


def test_unquoted_comma_is_reported(spark, csv):
    path = csv("a,Town, Far,S,X,1,2,UTC,true")
    with pytest.raises(ValueError, match="quoted"):
        active_locations(read_locations(spark, path))


def document(**changes):
    base = {
        "location_id": "a", "name": "Á", "ingested_at": "2024-01-05T00:00:00+00:00",
        "payload": {"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [1]}},
        "extra": {"ignored": True},
    }
    return json.dumps(base | changes, ensure_ascii=False)


def test_landing_reads_all_files_and_skips_blank_lines(spark, tmp_path):
    (tmp_path / "one.jsonl").write_text(document() + "\n\n   \n" + document(location_id="b"))
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "two.json").write_text(document(location_id="c"))
    (tmp_path / "note.txt").write_text("not landing")
    found = records(read_landing(spark, str(tmp_path)), "location_id", "name")
    assert found == [("a", "Á"), ("b", "Á"), ("c", "Á")]


def test_absent_keys_are_null(spark, tmp_path):
    (tmp_path / "one.jsonl").write_text('{"location_id": "a"}')
    row = read_landing(spark, str(tmp_path)).first()
    assert row["payload"] is None and row["country"] is None


def test_broken_line_fails_and_can_be_found(spark, tmp_path):
    (tmp_path / "one.jsonl").write_text(document() + '\n{"location_id": \n' + document())
    with pytest.raises((PySparkException, Py4JJavaError), match="one.jsonl"):
        read_landing(spark, str(tmp_path)).collect()
    broken = malformed_lines(spark, str(tmp_path)).collect()
    assert len(broken) == 1
    assert broken[0]["file_path"].endswith("one.jsonl") and broken[0]["line"] == 2
    assert broken[0]["malformed"].startswith('{"location_id":')


def test_no_landing_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        require_landing(spark, str(tmp_path / "absent"))
    (tmp_path / "note.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        read_landing(spark, str(tmp_path))


def test_windows_accumulate_and_a_window_is_overwritten(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.jsonl").write_text(document())
    docs = read_landing(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    write_landing(docs, out, "2024-01-01", "2024-01-07")
    write_landing(docs, out, "2024-01-01", "2024-01-07")
    write_landing(docs, out, "2024-01-08", "2024-01-14")
    assert read_landing(spark, out).count() == 2


def test_line_numbers_over_many_splits(spark, tmp_path):
    """Each file is cut into splits of 2,000 bytes, at places that have nothing to do with lines."""
    wanted = set()
    for name, lines, seed in (("a.jsonl", 900, 1), ("b.json", 3, 2), ("c.jsonl", 700, 3)):
        rng, text = random.Random(seed), ""
        for number in range(1, lines + 1):
            line = rng.choice(["", "  ", document(), document(name="x" * rng.randrange(300)), "{oh", "nö }"])
            text += line + rng.choice(["\n", "\r\n"])
            if line in ("{oh", "nö }"):
                wanted.add((name, number, line))
        (tmp_path / name).write_text(text, newline="")
    (tmp_path / "d.jsonl.gz").write_bytes(gzip.compress(b"{}\n\n[\n"))
    (tmp_path / "e.jsonl").write_text("")
    wanted.add(("d.jsonl.gz", 3, "["))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
        found = malformed_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r.file_path.split("/")[-1], r.line, r.malformed) for r in found} == wanted
    assert len(found) == len(wanted)
