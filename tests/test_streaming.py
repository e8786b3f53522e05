import json
import os
from datetime import date

import pytest

from rainfold.functions.dates import DateSet
from rainfold.operators.tables import read_bronze
from rainfold.operators.snapshots import read_table
from rainfold.plans import pipeline
from rainfold.plans.pipeline import Warehouse
from rainfold.schemas import DAILY, HOURLY
from rainfold.sources.landing import MalformedLanding
from rainfold.streaming.landing_stream import load_new_landing
from tests.helpers import records
from tests.test_pipeline import document


def land(folder, name, *documents):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(d) for d in documents))


def test_only_new_files_are_loaded(spark, tmp_path):
    landing, warehouse = tmp_path / "landing", Warehouse(spark, str(tmp_path / "root"))
    odd = document(day=3)
    odd["payload"]["hourly"]["time"][0] = "noon"
    land(landing, "one.jsonl", document(), document("b", day=2))
    assert load_new_landing(warehouse, str(landing)) == DateSet(
        frozenset([date(2024, 1, 1), date(2024, 1, 2)]))
    pipeline._clear_pending(warehouse, pipeline._pending_notes(warehouse), None)
    assert load_new_landing(warehouse, str(landing)) is None
    land(landing, "two.jsonl", odd, document(day=2, warm=5.0))
    assert load_new_landing(warehouse, str(landing), max_files_per_batch=1) == DateSet(
        frozenset([date(2024, 1, 2), date(2024, 1, 3)]))

    batch = Warehouse(spark, str(tmp_path / "batch"))
    pipeline.flatten_landing(batch, str(landing))
    pipeline.load_bronze(batch)
    for kind in (HOURLY, DAILY):
        streamed = read_bronze(spark, warehouse.bronze(kind), kind)
        loaded = read_bronze(spark, batch.bronze(kind), kind)
        assert records(streamed) == records(loaded)
    apart = spark.read.parquet(warehouse.path("quarantine", "hourly"))
    assert records(apart, "location_id", "observed_at") == [("a", None)]


def test_range_of_a_stream_load_drives_a_partial_rebuild(spark, tmp_path):
    landing, warehouse = tmp_path / "landing", Warehouse(spark, str(tmp_path / "root"))
    seed = tmp_path / "seed.csv"
    seed.write_text(
        "location_id,name,state,country,latitude,longitude,timezone,is_active\n"
        "a,A,S,X,1,2,UTC,true\n")
    land(landing, "one.jsonl", document(), document(day=2))
    dates = load_new_landing(warehouse, str(landing))
    pipeline.build_models(warehouse, str(seed), dates)
    land(landing, "two.jsonl", document(day=2, warm=5.0))
    dates = load_new_landing(warehouse, str(landing))
    pipeline.build_models(warehouse, str(seed), dates)
    fact = read_table(spark, warehouse.path("gold", "fct_daily"))
    assert records(fact, "dates", "temperature_2m_max") == [
        (date(2024, 1, 1), 5.75), (date(2024, 1, 2), 10.75)]


def test_files_count_whatever_their_age_and_others_do_not(spark, tmp_path):
    landing, warehouse = tmp_path / "landing", Warehouse(spark, str(tmp_path / "root"))
    land(landing, "new.jsonl", document())
    load_new_landing(warehouse, str(landing))
    land(landing, "old.jsonl", document(day=2))
    os.utime(landing / "old.jsonl", (1_500_000_000, 1_500_000_000))
    land(landing, "half.jsonl.tmp", document(day=3))
    waiting = load_new_landing(warehouse, str(landing))
    assert waiting == DateSet(frozenset([date(2024, 1, 1), date(2024, 1, 2)]))


def test_days_of_a_run_that_died_before_its_rebuild_come_back(spark, tmp_path):
    landing, warehouse = tmp_path / "landing", Warehouse(spark, str(tmp_path / "root"))
    seed = tmp_path / "seed.csv"
    seed.write_text(
        "location_id,name,state,country,latitude,longitude,timezone,is_active\n"
        "a,A,S,X,1,2,UTC,true\n")
    land(landing, "one.jsonl", document())
    assert load_new_landing(warehouse, str(landing)) is not None  # and no rebuild
    waiting = load_new_landing(warehouse, str(landing))
    assert waiting == DateSet(frozenset([date(2024, 1, 1)]))
    pipeline.build_models(warehouse, str(seed), waiting)
    assert load_new_landing(warehouse, str(landing)) is None
    assert read_table(spark, warehouse.path("gold", "fct_daily")).count() == 1


def test_days_that_arrive_during_a_build_stay_pending(spark, tmp_path):
    landing, warehouse = tmp_path / "landing", Warehouse(spark, str(tmp_path / "root"))
    seed = tmp_path / "seed.csv"
    seed.write_text(
        "location_id,name,state,country,latitude,longitude,timezone,is_active\n"
        "a,A,S,X,1,2,UTC,true\n")
    land(landing, "one.jsonl", document(), document(day=2))
    dates = load_new_landing(warehouse, str(landing))

    def arrive(name):
        if name == "fct_daily":
            pipeline.add_pending(warehouse, DateSet(frozenset([date(2024, 1, 2), date(2024, 1, 7)])))

    pipeline.build_models(warehouse, str(seed), dates, on_saved=arrive)
    assert pipeline.pending_dates(warehouse).days == {date(2024, 1, 2), date(2024, 1, 7)}
    # A build of some days leaves the others, and a full one leaves none.
    pipeline.build_models(warehouse, str(seed), DateSet(frozenset([date(2024, 1, 2)])))
    assert pipeline.pending_dates(warehouse).days == {date(2024, 1, 7)}
    pipeline.build_models(warehouse, str(seed))
    assert pipeline.pending_dates(warehouse) is None


def test_a_broken_line_stops_the_load_with_its_number(spark, tmp_path):
    landing, warehouse = tmp_path / "landing", Warehouse(spark, str(tmp_path / "root"))
    land(landing, "one.jsonl", document())
    (landing / "two.jsonl").write_text(json.dumps(document(day=2)) + "\n{half")
    with pytest.raises(MalformedLanding, match="two.jsonl line 2: {half"):
        load_new_landing(warehouse, str(landing))
