"""Tables that follow another table's loads."""

import random

import pytest

from rainfold.functions.dates import DateSet
from rainfold.operators import daily_state, derived, snapshots
from rainfold.operators.checks import freshness
from rainfold.operators.daily_state import load_with_state, next_state, stored_rollup
from rainfold.operators.latest import duplicate_count
from rainfold.operators.rollup import AGGREGATES, roll_up_to_days
from rainfold.operators.statistics import column_figures, follow_figures, key_figures, newest
from rainfold.operators.tables import load, prepare_load, read_bronze, write_partitioned
from rainfold.plans import pipeline
from rainfold.plans.declared_checks import declared_checks
from rainfold.schemas import DAILY, HOURLY
from tests.helpers import daily_rows, hourly_rows, records, ts
from tests.test_pipeline import SEED
from tests.test_tables import row


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "table"), str(tmp_path / "state")


def state_equals_rollup(spark, place):
    wanted = roll_up_to_days(read_bronze(spark, place[0], HOURLY))
    found = stored_rollup(spark, place[1])
    assert found.columns == wanted.columns
    assert records(found) == records(wanted)


def some_hours(spark, seed, days=4, places="abc"):
    rng = random.Random(seed)
    metric = lambda: rng.choice([None, rng.randrange(-40, 80) / 8])
    rows = [
        {"observed_at": f"2024-01-{day:02}T{hour:02}:00", "location_id": place,
         "ingested_at": f"2024-02-0{rng.randrange(1, 9)}"}
        | {m: metric() for m in HOURLY.metrics}
        for day in range(1, days + 1) for hour in range(24) for place in places
        if rng.random() < 0.2
    ]
    return hourly_rows(spark, *rows)


def test_state_equals_a_full_rollup_after_each_load(spark, place):
    load_with_state(some_hours(spark, 1, places="ab"), *place, "append")
    state_equals_rollup(spark, place)
    load_with_state(some_hours(spark, 2, days=6, places="c"), *place, "append")
    state_equals_rollup(spark, place)
    for seed in (3, 4):
        load_with_state(some_hours(spark, seed, days=3 + seed), *place)
        state_equals_rollup(spark, place)
    narrow = some_hours(spark, 5).select(*HOURLY.keys, "rain")
    load_with_state(narrow, *place)
    load_with_state(hourly_rows(spark, row(1, 1.0, location_id=None)), *place)
    load_with_state(hourly_rows(spark, row(1, 1.0, location_id=None)), *place)
    state_equals_rollup(spark, place)
    load_with_state(some_hours(spark, 6, days=2), *place, "replace")
    state_equals_rollup(spark, place)
    assert load_with_state(some_hours(spark, 6).limit(0), *place).skipped
    state_equals_rollup(spark, place)


def test_an_append_reads_no_stored_hour_and_an_upsert_touched_days_only(spark, place):
    load_with_state(some_hours(spark, 1, places="ab"), *place, "append")
    for batch, mode, days in (
        (some_hours(spark, 2, days=2, places="z"), "append", set()),
        (some_hours(spark, 1, days=1, places="ab"), "upsert", {"p_date=2024-01-01"}),
    ):
        change = prepare_load(batch, place[0], HOURLY, mode)
        change.publish()
        found = derived.stale(spark, *place)
        rows = next_state(spark, place[1], found, change)
        read = {f for f in rows.inputFiles() if f"{place[0]}/" in f}
        assert {f.split(f"{place[0]}/")[1].split("/")[0] for f in read} == days
        derived.replace_days(rows, place[1], "p_date", found)
        change.finish()
        state_equals_rollup(spark, place)


def test_a_state_that_fell_behind_is_made_up_for(spark, place):
    load_with_state(some_hours(spark, 1), *place)
    load(some_hours(spark, 2, days=2), place[0], HOURLY)  # without the state
    load_with_state(some_hours(spark, 3, days=1), *place)
    state_equals_rollup(spark, place)


def test_every_rollup_column_is_in_the_state():
    assert list(daily_state.FINISHED) == list(AGGREGATES)


def test_follow_computes_changed_days_only_and_drops_gone_ones(spark, place):
    seen = []

    def compute(rows):
        seen.append({f.split("p_date=")[1][:10] for f in rows.inputFiles()})
        return rows.groupBy("p_date").count()

    def days():
        return derived.follow(spark, *place, "p_date", compute)

    load(hourly_rows(spark, row(1), row(1, day=2), row(1, day=3)), place[0], HOURLY)
    assert {d.day for d in days()} == {1, 2, 3}
    assert days() == set()
    load(hourly_rows(spark, row(2, day=2)), place[0], HOURLY)
    assert {d.day for d in days()} == {2}
    load(hourly_rows(spark, row(2, day=3)), place[0], HOURLY, "replace")
    assert {d.day for d in days()} == {1, 2, 3}
    assert seen == [
        {"2024-01-01", "2024-01-02", "2024-01-03"}, {"2024-01-02"}, {"2024-01-03"}]
    assert records(snapshots.read_table(spark, place[1]), "count") == [(1,)]
    with pytest.raises(FileNotFoundError):
        derived.follow(spark, place[0] + "-absent", place[1], "p_date", compute)


def test_stored_figures(spark, place):
    for seed in (1, 2):
        load(some_hours(spark, seed), place[0], HOURLY)
        follow_figures(spark, *place, HOURLY)
    table = read_bronze(spark, place[0], HOURLY)
    for r in column_figures(spark, place[1], HOURLY).collect():
        least, most, nulls = table.selectExpr(
            f"cast(min({r['column']}) as string)", f"cast(max({r['column']}) as string)",
            f"count_if({r['column']} is null)",
        ).first()
        assert (r["least"], r["most"], r["nulls"]) == (least, most, nulls)
    assert records(key_figures(spark, place[1])) == records(duplicate_count(table, HOURLY.keys))
    now = ts("2024-02-20")
    assert records(freshness({"h": newest(spark, place[1])}, now)) == records(
        freshness({"h": table}, now))
    files = freshness({"h": newest(spark, place[1])}, now).inputFiles()
    assert files and not [f for f in files if f"{place[0]}/" in f]


def test_figures_of_a_table_that_holds_keys_twice(spark, place):
    write_partitioned(hourly_rows(spark, row(1), row(1), row(2, location_id=None)), place[0], "observed_at")
    follow_figures(spark, *place, HOURLY)
    assert records(key_figures(spark, place[1])) == [(3, 2, 1)]
    nulls = {r["column"]: r["nulls"] for r in column_figures(spark, place[1], HOURLY).collect()}
    assert nulls["location_id"] == 1 and nulls["rain"] == 3 and nulls["observed_at"] == 0


def test_checks_follow_changed_days(spark, tmp_path):
    warehouse = pipeline.Warehouse(spark, str(tmp_path / "root"))
    seed = tmp_path / "seed.csv"
    seed.write_text(SEED)
    hot = [row(h, 1.0, day=d, temperature_2m=90.0 if d == 2 else 5.0) for d in (1, 2) for h in (1, 2)]
    load(hourly_rows(spark, *hot), warehouse.bronze(HOURLY), HOURLY)
    load(daily_rows(spark, {"date": "2024-01-01", "rain_sum": -1.0}), warehouse.bronze(DAILY), DAILY)
    models = pipeline.build_models(warehouse, str(seed))
    report, looked_at = pipeline.check_models(warehouse)
    whole = pipeline.run_checks(models, declared_checks())
    assert records(report) == records(whole)
    assert {d.day for d in looked_at["hourly_enriched"]} == {1, 2}
    assert report.where("status = 'fail'").count() > 3

    cooler = hourly_rows(spark, *[row(h, 1.0, day=2, temperature_2m=6.0) for h in (1, 2)])
    dates = load(cooler, warehouse.bronze(HOURLY), HOURLY).dates
    assert isinstance(dates, DateSet)
    models = pipeline.build_models(warehouse, str(seed), dates)
    report, looked_at = pipeline.check_models(warehouse)
    assert {d.day for d in looked_at["hourly_enriched"]} == {2}
    assert looked_at["daily_enriched"] == {ts("2024-01-02").date()} or not looked_at["daily_enriched"]
    models = pipeline.build_models(warehouse, str(seed))
    assert records(report) == records(pipeline.run_checks(models, declared_checks()))
