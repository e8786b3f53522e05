import json
from datetime import date, datetime

import pytest

from rainfold.functions.dates import DateRange
from rainfold.operators.snapshots import read_table
from rainfold.plans import pipeline
from rainfold.plans.pipeline import StaleSource, Warehouse
from rainfold.schemas import DAILY, HOURLY
from rainfold.sources.landing import MalformedLanding
from tests.helpers import records

SEED = (
    "location_id,name,state,country,latitude,longitude,timezone,is_active\n"
    "a,A,S,X,1,2,UTC,true\nb,B,S,X,3,4,UTC,no\n"
)
NOW = datetime(2024, 1, 10)


def document(location="a", day=1, ingested="2024-01-08T00:00:00+00:00", warm=0.0, **more):
    times = [f"2024-01-{day:02}T{hour:02}:00" for hour in range(24)]
    payload = {
        "latitude": 1.0, "longitude": 2.0,
        "hourly": {
            "time": times, "temperature_2m": [warm + hour / 4 for hour in range(24)],
            "relative_humidity_2m": [50] * 24, "precipitation": [0.5] * 24, "rain": [0.5] * 24,
            "snowfall": [0] * 24, "snow_depth": [0] * 24, "wind_speed_10m": [7] * 24},
        "daily": {
            "time": [f"2024-01-{day:02}"], "temperature_2m_max": [warm + 5.75],
            "temperature_2m_min": [warm], "temperature_2m_mean": [warm + 3],
            "rain_sum": [12], "precipitation_sum": [12], "snowfall_sum": [0],
            "sunshine_duration": [3600]},
    }
    return {"location_id": location, "ingested_at": ingested, "payload": payload} | more


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        landing = tmp_path / "landing"
        seed = tmp_path / "seed.csv"
        warehouse = Warehouse(spark, str(tmp_path / "root"))

        def land(self, name, *documents):
            self.landing.mkdir(exist_ok=True)
            (self.landing / name).write_text("\n".join(json.dumps(d) for d in documents))

        def run(self, **more):
            return pipeline.run(
                self.warehouse, str(self.landing), str(self.seed), NOW, **more)

        def read(self, layer, name):
            return read_table(spark, self.warehouse.path(layer, name))

    place = Place()
    place.seed.write_text(SEED)
    return place


def test_whole_run(place):
    place.land("one.jsonl", document(), document("b"), document(day=2))
    place.land("two.jsonl", document(ingested="2024-01-09T00:00:00+00:00", warm=1.0))
    report = place.run()
    assert report.count() == 107
    assert records(report.where("status <> 'pass'")) == []
    assert records(place.read("gold", "fct_daily"), "location_id", "dates",
                   "temperature_2m_max", "precipitation_sum", "precip_hours") == [
        ("a", date(2024, 1, 1), 6.75, 12.0, 24),
        ("a", date(2024, 1, 2), 5.75, 12.0, 24),
        ("b", date(2024, 1, 1), 5.75, 12.0, 24)]
    assert {row["reconciliation_status"] for row in
            place.read("gold", "fct_daily_quality").collect()} == {"ok"}
    assert place.read("silver", "hourly_enriched").count() == 72
    assert place.read("silver", "daily_enriched").count() == 3
    assert records(place.read("gold", "dim_locations"), "location_id", "is_active") == [
        ("a", True), ("b", False)]


def test_second_run_changes_nothing(place):
    place.land("one.jsonl", document(), document("b"))
    place.run()
    first = {name: records(place.read(layer, name))
             for name, (layer, _) in pipeline.TABLES.items()}
    place.run()
    assert first == {name: records(place.read(layer, name))
                     for name, (layer, _) in pipeline.TABLES.items()}


def test_run_for_some_dates_equals_a_full_run(place):
    place.land("one.jsonl", document(), document(day=2), document(day=3))
    place.run()
    place.land("two.jsonl", document(day=2, ingested="2024-01-09T00:00:00+00:00", warm=3.0))
    day = date(2024, 1, 2)
    report = place.run(dates=DateRange(day, day))
    assert report.where("status <> 'pass'").count() == 0
    partial = {name: records(place.read(layer, name))
               for name, (layer, _) in pipeline.TABLES.items()}
    place.run()
    assert partial == {name: records(place.read(layer, name))
                       for name, (layer, _) in pipeline.TABLES.items()}


def test_stale_source_stops_before_models(place):
    place.land("one.jsonl", document(ingested="2023-11-01T00:00:00+00:00"))
    with pytest.raises(StaleSource):
        place.run()
    with pytest.raises(FileNotFoundError):
        place.read("gold", "fct_daily")


def test_aging_source_only_warns(place):
    place.land("one.jsonl", document(ingested="2024-01-02T00:00:00+00:00"))
    place.run()
    assert {row["status"] for row in
            pipeline.check_sources(place.warehouse, NOW).collect()} == {"warn"}


def test_bad_data_is_reported_not_blocked(place):
    hot = document()
    hot["payload"]["hourly"]["temperature_2m"][3] = 99.0
    place.land("one.jsonl", hot)
    failed = records(place.run().where("status = 'fail'"), "table", "failures")
    assert ("stg_hourly", 1) in failed and ("fct_daily", 1) in failed
    assert place.read("gold", "fct_daily").count() == 1


def test_unparsable_times_are_counted_and_left_out(place):
    odd = document()
    odd["payload"]["hourly"]["time"][0] = "midnight"
    place.land("one.jsonl", odd)
    assert pipeline.flatten_landing(place.warehouse, str(place.landing)) == {
        "hourly": 1, "daily": 0}
    reports = pipeline.load_bronze(place.warehouse)
    assert (reports["hourly"].rows_loaded, reports["daily"].rows_loaded) == (23, 1)


def test_broken_line_leaves_datasets_alone(place, spark):
    place.land("one.jsonl", document())
    pipeline.flatten_landing(place.warehouse, str(place.landing))
    (place.landing / "two.jsonl").write_text("\n\n{broken")
    with pytest.raises(MalformedLanding, match="two.jsonl line 3: {broken"):
        pipeline.flatten_landing(place.warehouse, str(place.landing))
    usable, _ = pipeline.bronze_files(place.warehouse, HOURLY)
    assert usable.count() == 24


def test_tables_by_name_and_alias(place, spark):
    place.land("one.jsonl", document())
    renamed = Warehouse(spark, place.warehouse.root, {"fct_daily": "daily_canonical"})
    pipeline.flatten_landing(renamed, str(place.landing))
    pipeline.load_bronze(renamed)
    pipeline.build_models(renamed, str(place.seed), registered=True)
    assert spark.sql(
        "select d.location_name from gold.daily_canonical f join gold.dim_locations d "
        "using (location_id) where f.dates = date'2024-01-01'").first()[0] == "A"
    assert spark.sql("select count(*) from stg_hourly").first()[0] == 24
    for name, (layer, _) in pipeline.TABLES.items():
        spark.sql(f"drop table {layer}.{renamed.aliases.get(name, name)}")
    for view in ("stg_hourly", "stg_daily"):
        spark.catalog.dropTempView(view)


def test_daily_only_and_hourly_only_documents(place):
    days_only = document()
    del days_only["payload"]["hourly"]
    hours_only = document(day=2)
    del hours_only["payload"]["daily"]
    place.land("one.jsonl", days_only, hours_only, document(day=3, payload=None))
    place.run()
    assert records(place.read("gold", "fct_daily"), "dates", "temperature_source") == [
        (date(2024, 1, 1), "api_daily"), (date(2024, 1, 2), "hourly_derived")]
    assert DAILY.keys == ("location_id", "date")


def test_daily_tables_are_written_from_pairs_stored_by_day(place, spark, monkeypatch):
    """Only what is not stored by date is shuffled by date: the rollup and the pairs."""
    place.land("one.jsonl", document(), document("b", day=2), document(day=3))
    pipeline.flatten_landing(place.warehouse, str(place.landing))
    pipeline.load_bronze(place.warehouse)
    written = {}

    def write(df, path, partition=None, dates=None, stored_by_date=False):
        text = df._jdf.queryExecution().executedPlan().toString()
        # What is left is the dedup of rows without a location.
        exchanges = text.count("Exchange hashpartitioning") + text.count("Exchange rebalance")
        written[path.split("/")[-1]] = exchanges, stored_by_date
        return write_table(df, path, partition, dates, stored_by_date)

    write_table = pipeline.write_table
    monkeypatch.setattr(pipeline, "write_table", write)
    pipeline.build_models(place.warehouse, str(place.seed))
    daily = {name: found for name, found in written.items() if name != "hourly_enriched"}
    assert set(daily.values()) == {(0, True)}
    assert written["hourly_enriched"] == (1, True)
    for name, (layer, partition) in pipeline.TABLES.items():
        if partition:
            table = place.read(layer, name)
            files = [f.split(f"{partition}=")[1].split("/")[0] for f in table.inputFiles()]
            assert len(files) == len(set(files)) == 3
