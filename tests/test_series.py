import json

import pytest
from pyspark.errors import PySparkException

from rainfold.operators.series import explode_series, landing_records, pack_series, split_unparsable
from rainfold.operators.stack import stack_by_name
from rainfold.schemas import DAILY, HOURLY, LANDING
from tests.helpers import daily_rows, hourly_rows, records, ts


def landing(spark, *payloads):
    lines = [
        json.dumps({"location_id": f"l{i}", "ingested_at": "2024-01-05T01:00:00+01:00",
                    "payload": payload})
        for i, payload in enumerate(payloads)
    ]
    text = spark.createDataFrame([(line,) for line in lines], "value string")
    return text.selectExpr(
        f"inline(array(from_json(value, '{LANDING.simpleString()}', map('mode', 'FAILFAST'))))"
    )


def hourly(**series):
    return {"hourly": series}


TWO = ["2024-01-01T23:00", "2024-01-02T00:00"]


def test_rows_per_element_with_constants(spark):
    rows = explode_series(
        landing(spark, hourly(time=TWO, temperature_2m=[1.5, None], rain=[0, 2])), HOURLY
    )
    assert rows.schema.fieldNames() == HOURLY.schema.fieldNames()
    assert records(rows, "location_id", "observed_at", "ingested_at", "temperature_2m", "rain",
                   "snowfall", "p_date") == [
        ("l0", ts("2024-01-01T23:00"), ts("2024-01-05T00:00"), 1.5, 0.0, None,
         ts("2024-01-01").date()),
        ("l0", ts("2024-01-02T00:00"), ts("2024-01-05T00:00"), None, 2.0, None,
         ts("2024-01-02").date()),
    ]


@pytest.mark.parametrize(
    "payload",
    [None, {}, {"hourly": None}, hourly(), hourly(time=None), hourly(time=[]),
     hourly(time=[], rain=[1])],
)
def test_nothing_to_explode(spark, payload):
    assert explode_series(landing(spark, payload), HOURLY).count() == 0


def test_null_variable_keeps_rows(spark):
    rows = explode_series(landing(spark, hourly(time=TWO, rain=None, snowfall=[1, 2])), HOURLY)
    assert records(rows, "rain", "snowfall") == [(None, 1.0), (None, 2.0)]


@pytest.mark.parametrize("rain", [[], [1], [1, 2, 3]])
def test_length_mismatch_fails(spark, rain):
    with pytest.raises(PySparkException, match="series rain has"):
        explode_series(landing(spark, hourly(time=TWO, rain=rain)), HOURLY).collect()


def test_daily_block(spark):
    rows = explode_series(
        landing(spark, {"daily": {"time": ["2024-01-01"], "rain_sum": [2.5]}}), DAILY
    )
    assert records(rows, "date", "rain_sum", "sunshine_duration") == [
        (ts("2024-01-01"), 2.5, None)]


def test_unparsable_times_are_set_apart(spark):
    rows = explode_series(landing(spark, hourly(time=["soon", TWO[0]], rain=[1, 2])), HOURLY)
    usable, apart = split_unparsable(rows)
    assert records(usable, "rain") == [(2.0,)]
    assert records(apart, "observed_at", "rain") == [(None, 1.0)]


def test_pack_is_the_inverse_of_explode(spark):
    rows = hourly_rows(
        spark,
        {"observed_at": "2024-01-31T23:00", "rain": 1.0},
        {"observed_at": "2024-02-01T00:00", "rain": None, "temperature_2m": -2.5},
        {"observed_at": "2024-01-01T05:00", "rain": 3.0},
        {"observed_at": "2024-01-01T05:00", "rain": 4.0, "location_id": "b"},
    )
    days = daily_rows(spark, {"date": "2024-01-31", "rain_sum": 4.0}, {"date": "2024-03-01"})
    places = spark.createDataFrame(
        [("a", "A", "X", "UTC", 1.0, 2.0)],
        "location_id string, name string, country string, timezone string, "
        "latitude double, longitude double",
    )
    docs = landing_records(rows, days, places)
    assert docs.count() == 4
    assert [f.name for f in docs.schema] == LANDING.fieldNames()
    assert records(explode_series(docs, HOURLY), *HOURLY.schema.fieldNames()) == records(
        rows, *HOURLY.schema.fieldNames())
    assert records(explode_series(docs, DAILY), *DAILY.schema.fieldNames()) == records(
        days, *DAILY.schema.fieldNames())


def test_packed_times_are_sorted(spark):
    rows = hourly_rows(
        spark, *[{"observed_at": f"2024-01-01T{hour:02}:00"} for hour in (5, 1, 23, 0)]
    )
    block = pack_series(rows, HOURLY).first()["hourly"]
    assert block["time"] == [f"2024-01-01T{hour:02}:00" for hour in (0, 1, 5, 23)]


def test_stack_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "z int, x int")
    assert records(stack_by_name([a, b]), "x", "y", "z") == [(1, 2, None), (4, None, 3)]
