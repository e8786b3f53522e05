from datetime import date, datetime

import pytest

from rainfold.functions.dates import DateSet
from rainfold.operators import snapshots, tables
from rainfold.operators.rollup import roll_up_to_days
from rainfold.operators.snapshots import read_table
from rainfold.operators.tables import load, share_locations
from rainfold.plans import pipeline
from rainfold.plans.enriched import pair_daily, rollup_of_pairs
from rainfold.plans.pipeline import Warehouse
from rainfold.plans.staging import stg_daily, stg_hourly
from rainfold.schemas import DAILY, HOURLY
from tests.helpers import records

SEED = (
    "location_id,name,state,country,latitude,longitude,timezone,is_active\n"
    "a,A,S,X,1,2,UTC,true\nb,B,S,X,3,4,UTC,no\n"
)
DAYS = DateSet(frozenset({date(2024, 1, 1), date(2024, 1, 2)}))
DATED = {name: at for name, at in pipeline.TABLES.items() if at[1]}


def hours(spark, *rows):
    """Location, day, hour and rain."""
    full = [(place, datetime(2024, 1, day, hour), datetime(2024, 1, 9), 1.0, 1.0, rain, rain,
             0.0, 0.0, 1.0, date(2024, 1, day)) for place, day, hour, rain in rows]
    return spark.createDataFrame(full, HOURLY.schema)


def days(spark, *rows):
    """Location, day and rain."""
    full = [(place, datetime(2024, 1, day), datetime(2024, 1, 9), 1.0, 1.0, 1.0, rain, rain, 0.0,
             60.0, date(2024, 1, day)) for place, day, rain in rows]
    return spark.createDataFrame(full, DAILY.schema)


class Place:
    def __init__(self, spark, folder):
        self.spark, self.warehouse = spark, Warehouse(spark, str(folder / "root"))
        self.seed = str(folder / "seed.csv")
        folder.mkdir(exist_ok=True)
        (folder / "seed.csv").write_text(SEED)

    def load(self, hourly=(), daily=()):
        load(hours(self.spark, *hourly), self.warehouse.bronze(HOURLY), HOURLY)
        load(days(self.spark, *daily), self.warehouse.bronze(DAILY), DAILY)

    def build(self, dates=None, **more):
        pipeline.build_models(self.warehouse, self.seed, dates, **more)

    def loads(self, day):
        found = {}
        for name, (layer, partition) in DATED.items():
            live = snapshots.current(self.spark, self.warehouse.path(layer, name)).live
            found[name] = live.get(f"{partition}={date(2024, 1, day)}", [])
        return found

    def content(self):
        return {name: records(read_table(self.spark, self.warehouse.path(layer, name)))
                for name, (layer, _) in pipeline.TABLES.items()}


@pytest.fixture
def place(spark, tmp_path):
    made = Place(spark, tmp_path / "made")
    made.load([("a", 1, 0, 0.5), ("a", 1, 1, 1.5), ("a", 2, 0, 3.0)], [("a", 1, 2.0)])
    made.build()
    return made


def as_new(place, tmp_path):
    """What a first build of the same bronze tables gives."""
    fresh = Place(place.spark, tmp_path / "fresh")
    for kind in (HOURLY, DAILY):
        load(read_table(place.spark, place.warehouse.bronze(kind)), fresh.warehouse.bronze(kind), kind)
    fresh.build()
    return fresh.content()


def test_new_locations_are_added_and_other_days_built_again(place, tmp_path):
    before = {day: place.loads(day) for day in (1, 2)}
    place.load([("b", 1, 5, 7.0), ("a", 2, 7, 9.0)], [("b", 1, 7.0), ("b", 2, 1.0)])
    place.build(DAYS)
    for name, loads in place.loads(1).items():
        assert len(loads) == 2 and loads[:1] == before[1][name]
    for name, loads in place.loads(2).items():
        assert len(loads) == 1 and loads != before[2][name]
    assert place.content() == as_new(place, tmp_path)


@pytest.mark.parametrize("hourly, daily", [
    ([], [("a", 2, 5.0)]),  # The feed of a day that only hours were known of.
    ([("a", 1, 9, 5.0)], []),
    ([(None, 1, 9, 5.0), (None, 2, 9, 5.0)], [("b", 1, 1.0), ("b", 2, 1.0)]),
])
def test_readings_of_known_locations_or_none_build_the_day_again(place, tmp_path, hourly, daily):
    place.load(hourly, daily)
    place.build(DAYS)
    for day in {row[1] for row in [*hourly, *daily]}:
        assert {len(loads) for loads in place.loads(day).values()} <= {0, 1}
    assert place.content() == as_new(place, tmp_path)


def test_a_build_that_died_is_made_up_for(place, tmp_path):
    place.load([("b", 1, 5, 7.0)], [("b", 1, 7.0)])

    def die(name):
        raise OSError(name)

    with pytest.raises(OSError):
        place.build(DAYS, on_saved=die)
    place.build(DAYS)
    assert {len(loads) for loads in place.loads(1).values()} == {1}
    assert place.content() == as_new(place, tmp_path)


def test_days_without_new_loads_are_built_again_when_asked_for(place, tmp_path):
    before = place.loads(1)
    place.build(DAYS)
    assert all(loads != before[name] for name, loads in place.loads(1).items())
    assert place.content() == as_new(place, tmp_path)


def test_many_small_additions_are_built_as_one(place, tmp_path):
    for n in range(9):
        place.load([(f"c{n}", 1, 5, 7.0)])
        place.build(DAYS)
    assert max(len(loads) for loads in place.loads(1).values()) <= 8
    assert place.content() == as_new(place, tmp_path)


def test_rollup_of_pairs_is_the_rollup(spark):
    rollup = roll_up_to_days(stg_hourly(hours(
        spark, ("a", 1, 3, 2.0), ("a", 2, 3, 4.0), (None, 1, 3, 1.0))))
    late = days(spark, ("a", 1, 3.0), (None, 1, 1.0)).selectExpr(
        "* except (date)", "date + interval 6 hours as date")
    feed = days(spark, ("a", 1, 3.0), ("b", 1, 3.0), (None, 1, 2.0)).unionByName(late)
    pairs = pair_daily(stg_daily(feed), rollup, marked=True)
    assert pairs.where("location_id = 'a'").count() == 3
    found = rollup_of_pairs(pairs)
    assert records(found) == records(rollup.select(*found.columns))
    assert set(found.columns) == set(rollup.columns)


@pytest.mark.parametrize("added, shared", [
    (("b",), False), (("b", "a"), True), ((None,), True), ((), False)])
def test_share_locations(spark, added, shared):
    there = hours(spark, ("a", 1, 0, 1.0), ("c", 1, 0, 1.0), (None, 1, 0, 1.0))
    assert share_locations(hours(spark, *[(place, 1, 1, 1.0) for place in added]), there) == shared


def test_keys_of_new_locations_are_not_compared(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "table"), []
    load(hours(spark, ("a", 1, 0, 1.0)), path, HOURLY)
    compare = tables._days_of_known_keys
    monkeypatch.setattr(
        tables, "_days_of_known_keys", lambda *frames: seen.append(compare(*frames)) or seen[-1])
    load(hours(spark, ("b", 1, 0, 2.0)), path, HOURLY)
    load(hours(spark, ("b", 1, 0, 3.0), ("d", 1, 1, 3.0)), path, HOURLY)
    assert seen == [[], [date(2024, 1, 1)]]
    assert records(read_table(spark, path), "location_id", "rain") == [
        ("a", 1.0), ("b", 3.0), ("d", 3.0)]
