import json
from datetime import datetime

import pytest

from rainfold.operators.open_series import explode_open, open_variables
from rainfold.operators.snapshots import read_table
from rainfold.plans import pipeline
from rainfold.plans.pipeline import Warehouse
from rainfold.schemas import HOURLY, OPEN_LANDING
from rainfold.sources.landing import read_landing
from rainfold.streaming.landing_stream import load_new_landing
from rainfold.operators.tables import read_bronze
from tests.helpers import records
from tests.test_pipeline import NOW, SEED, document

TIMES = ["2024-01-01T00:00", "2024-01-01T01:00"]


@pytest.fixture
def landed(spark, tmp_path):
    def write(*blocks):
        lines = [
            {"location_id": f"l{i}", "ingested_at": "2024-01-05T00:00:00+00:00"}
            | ({} if block is None else {"payload": {"hourly": block}})
            for i, block in enumerate(blocks)
        ]
        (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, lines)))
        return read_landing(spark, str(tmp_path), OPEN_LANDING)

    return write


def test_every_key_of_a_block_becomes_a_column(landed):
    docs = landed(
        {"time": TIMES, "rain": [1, None], "sky": ["a", "b"], "model": "x7", "dew point": [1.5, 2]},
        {"time": TIMES[:1], "rain": [2.25], "gone": None, "mixed": ["1"], "level": 4,
         "ingested_at": ["no"], "location_id": "other"},
        {"time": [], "rain": []}, {"rain": [1], "mixed": [2]}, None,
    )
    variables = open_variables(docs, HOURLY)
    assert variables == {
        "dew point": "double", "gone": "double", "level": "double", "mixed": "string",
        "model": "string", "rain": "double", "sky": "string",
    }
    rows = explode_open(docs, HOURLY, variables)
    assert rows.columns == ["location_id", "observed_at", "ingested_at", *variables, "p_date"]
    assert records(rows, "location_id", "observed_at", "`dew point`", "gone", "level", "mixed",
                   "model", "rain", "sky") == [
        ("l0", datetime(2024, 1, 1, 0), 1.5, None, None, None, "x7", 1.0, "a"),
        ("l0", datetime(2024, 1, 1, 1), 2.0, None, None, None, "x7", None, "b"),
        ("l1", datetime(2024, 1, 1, 0), None, None, 4.0, "1", None, 2.25, None),
    ]


def test_another_length_is_an_error(landed):
    docs = landed({"time": TIMES, "sleet": [1, 2, 3]})
    with pytest.raises(Exception, match="series sleet has 3 values for 2 times"):
        explode_open(docs, HOURLY, open_variables(docs, HOURLY)).collect()


def test_names_that_differ_in_case_only_are_an_error(landed):
    with pytest.raises(ValueError, match="'Rain', 'rain'"):
        open_variables(landed({"time": TIMES, "Rain": [1, 2], "rain": [1, 2]}), HOURLY)
    with pytest.raises(ValueError, match="Observed_At"):
        open_variables(landed({"time": TIMES, "Observed_At": [1, 2]}), HOURLY)


def test_whole_run_with_open_variables(spark, tmp_path):
    landing, seed = tmp_path / "landing", tmp_path / "seed.csv"
    landing.mkdir()
    seed.write_text(SEED)
    odd = document()
    odd["payload"]["hourly"]["gusts"] = [9] * 24
    (landing / "one.jsonl").write_text(json.dumps(odd))
    runs = {}
    for is_open in (False, True):
        warehouse = Warehouse(spark, str(tmp_path / f"root{is_open}"))
        report = pipeline.run(warehouse, str(landing), str(seed), NOW, open_variables=is_open)
        assert report.where("status <> 'pass'").count() == 0
        table = read_bronze(spark, warehouse.bronze(HOURLY), HOURLY)
        assert ("gusts" in table.columns) == is_open
        runs[is_open] = records(read_table(spark, warehouse.path("gold", "fct_daily")))
    assert runs[False] == runs[True]


def test_deliveries_with_other_variables_grow_the_table(spark, tmp_path):
    landing, warehouse = tmp_path / "landing", Warehouse(spark, str(tmp_path / "root"))
    landing.mkdir()
    for day, name in ((1, "gusts"), (2, "dew")):
        more = document(day=day)
        more["payload"]["hourly"][name] = [day] * 24
        (landing / f"{day}.jsonl").write_text(json.dumps(more))
        load_new_landing(warehouse, str(landing), open_variables=True)
    table = read_bronze(spark, warehouse.bronze(HOURLY), HOURLY)
    assert table.columns == [*HOURLY.schema.fieldNames()[:-1], "gusts", "dew", "p_date"]
    found = table.groupBy("p_date").agg({"gusts": "max", "dew": "max"}).collect()
    assert sorted((r["p_date"].day, r["max(gusts)"], r["max(dew)"]) for r in found) == [
        (1, 1.0, None), (2, None, 2.0)]
