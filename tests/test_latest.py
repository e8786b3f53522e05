import random

from rainfold.operators.latest import duplicate_count, latest_by_key
from rainfold.plans.staging import stg_daily, stg_hourly, typed
from rainfold.schemas import DAILY, HOURLY
from tests.helpers import daily_rows, hourly_rows, records

HOUR = "2024-01-01T05:00"


def test_newest_row_wins(spark):
    rows = hourly_rows(
        spark,
        {"observed_at": HOUR, "ingested_at": "2024-01-02", "rain": 2.0},
        {"observed_at": HOUR, "ingested_at": "2024-01-03", "rain": 3.0},
        {"observed_at": HOUR, "ingested_at": "2024-01-01", "rain": 1.0},
        {"observed_at": HOUR, "location_id": "b", "ingested_at": "2024-01-01", "rain": 9.0},
    )
    assert records(stg_hourly(rows), "location_id", "rain") == [("a", 3.0), ("b", 9.0)]


def test_null_ingestion_counts_as_newest(spark):
    rows = hourly_rows(
        spark,
        {"observed_at": HOUR, "ingested_at": "2024-01-02", "rain": 2.0},
        {"observed_at": HOUR, "ingested_at": None, "rain": 1.0},
    )
    assert records(stg_hourly(rows), "rain") == [(1.0,)]


def test_null_keys_are_one_key(spark):
    rows = hourly_rows(
        spark,
        {"observed_at": HOUR, "location_id": None, "ingested_at": "2024-01-02", "rain": 2.0},
        {"observed_at": HOUR, "location_id": None, "ingested_at": "2024-01-03", "rain": 3.0},
    )
    assert records(latest_by_key(rows, HOURLY.keys), "rain") == [(3.0,)]


def test_ties_resolve_the_same_way_in_any_row_order(spark):
    rows = [{"observed_at": HOUR, "rain": float(n)} for n in range(40)]
    picked = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = hourly_rows(spark, *rows).repartition(seed + 1)
        picked.add(latest_by_key(df, HOURLY.keys).first()["rain"])
    assert len(picked) == 1


def test_works_without_order_columns(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    assert latest_by_key(df, ["k"]).count() == 2
    assert latest_by_key(df.select("k"), ["k"]).count() == 2


def test_duplicate_count(spark):
    rows = hourly_rows(spark, *[{"observed_at": HOUR}] * 3, {"observed_at": "2024-01-01T06:00"})
    assert records(duplicate_count(rows, HOURLY.keys)) == [(4, 2, 2)]
    assert records(duplicate_count(rows.limit(0), HOURLY.keys)) == [(0, 0, 0)]


def test_typed_columns(spark):
    rows = daily_rows(spark, {"date": "2024-01-01", "rain_sum": 1.0})
    text = rows.select([rows[c].cast("string") for c in rows.columns])
    assert typed(text, DAILY).dtypes == [
        ("location_id", "string"), ("dates", "timestamp_ntz"), ("ingested_at", "timestamp_ntz"),
        ("p_date", "date"), *[(metric, "double") for metric in DAILY.metrics]]
    assert records(typed(text, DAILY)) == records(typed(rows, DAILY))


def test_daily_dedup(spark):
    rows = daily_rows(
        spark,
        {"date": "2024-01-01", "ingested_at": "2024-01-02", "rain_sum": 1.0},
        {"date": "2024-01-01", "ingested_at": "2024-01-03", "rain_sum": 2.0},
    )
    assert records(stg_daily(rows), "rain_sum") == [(2.0,)]


def test_loaded_rows_are_looked_through_for_copies_without_a_whole_key_only(spark):
    nameless = {"observed_at": "2024-01-01T02:00", "location_id": None}
    rows = hourly_rows(
        spark, {"observed_at": "2024-01-01T01:00", "rain": 1.0},
        nameless | {"rain": 2.0, "ingested_at": "2024-02-02"},
        nameless | {"rain": 3.0, "ingested_at": "2024-02-03"},
    )
    assert records(stg_hourly(rows, loaded=True), "rain") == [(1.0,), (3.0,)]
    assert records(stg_hourly(rows, loaded=True)) == records(stg_hourly(rows))
