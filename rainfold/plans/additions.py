"""Days that a rebuild can add to instead of making them anew.

A note of the last builds says, by day, which loads of the sources the models show and which loads each
model table had after them. Where the sources have only been added to since, the tables are as noted,
and no added reading is of a location that the day has already, every row of the day stays as it is: the
rebuild reads the added loads alone, and the tables get a folder more. All other days are built from all
their readings. A build that died half way, or another writer, leaves tables that differ from the note.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace as changed
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainfold.functions.dates import DateSet
from rainfold.operators import snapshots
from rainfold.operators.derived import day_of
from rainfold.operators.snapshots import Snapshot, read_snapshot
from rainfold.operators.tables import MOST_LOADS, PARTITION, share_locations


@dataclass(frozen=True)
class Tables:
    """Tables as they are now, by path, and the file that notes them."""

    note: str
    sources: dict[str, Snapshot]
    models: dict[str, Snapshot | None]

    def loads(self, which: dict[str, Snapshot | None]) -> dict[date | None, set[str]]:
        """By day the names of its loads, each with its table."""
        found: dict[date | None, set[str]] = {}
        for path, snapshot in which.items():
            for part, loads in snapshot.live.items() if snapshot else ():
                found.setdefault(day_of(part), set()).update(f"{path} {load}" for load in loads)
        return found


def _noted(spark: SparkSession, tables: Tables) -> dict[str, list[str]]:
    found = snapshots.current(spark, tables.note)
    return found.made_from if found else {}


def note_built(spark: SparkSession, tables: Tables, dates: Iterable[date] | None) -> None:
    """Note what days were built from, None standing for all; ``sources`` are as the build read them."""
    built, models = tables.loads(tables.sources), tables.loads(tables.models)
    noted = {} if dates is None else _noted(spark, tables)
    for day in {*built, *models} if dates is None else dates:
        noted[str(day)] = sorted(built.get(day, set()) | models.get(day, set()))
    kept = {day: loads for day, loads in noted.items() if loads}
    snapshots.publish(spark, tables.note, Snapshot(T.StructType([]), made_from=kept))


def written_since(spark: SparkSession, path: str, before: Snapshot | None) -> DataFrame:
    """The rows of a model table that it has got since ``before``."""
    now = snapshots.current(spark, path)
    known = before.live if before else {}
    live = {
        part: new
        for part, loads in now.live.items()
        if (new := [load for load in loads if load not in known.get(part, ())])
    }
    return read_snapshot(spark, path, changed(now, live=live))


def days_to_add(
    spark: SparkSession, tables: Tables, dates: Iterable[date], cells: str
) -> tuple[DateSet, dict[str, Snapshot]]:
    """The days of ``dates`` that can be added to, and the sources with only the added loads of them.

    ``cells`` is the model table with a row for each location and day that any model has.
    """
    noted = {day: set(noted) for day, noted in _noted(spark, tables).items()}
    now, models = tables.loads(tables.sources), tables.loads(tables.models)
    days = set()
    for day in dates:
        known, held = noted.get(str(day), set()), models.get(day, set())
        loads = now.get(day, set())
        # What the note has beside the models' own loads are loads of the sources.
        if known and held <= known and known - held <= loads and loads - known:
            days.add(day)
    for snapshot in tables.models.values():
        for part, loads in snapshot.live.items() if snapshot else ():
            if len(loads) >= MOST_LOADS:
                days.discard(day_of(part))
    if days:
        added = _added(tables, noted, days)
        days -= _changed_days(spark, added, days, cells, tables.models[cells])
    return DateSet(frozenset(days)), _added(tables, noted, days)


def _added(
    tables: Tables, noted: dict[str, set[str]], days: set[date]
) -> dict[str, Snapshot]:
    """The sources, but of ``days`` only the loads that the note lacks."""
    found = {}
    for path, snapshot in tables.sources.items():
        live = {}
        for part, loads in snapshot.live.items():
            day = day_of(part)
            known = noted[str(day)] if day in days else ()
            if left := [load for load in loads if f"{path} {load}" not in known]:
                live[part] = left
        found[path] = changed(snapshot, live=live)
    return found


def _changed_days(
    spark: SparkSession, sources: dict[str, Snapshot], days: set[date], path: str, known: Snapshot
) -> set[date]:
    """The days on which the sources have a reading of a location that the day has, or of none."""
    cell = ["location_id", PARTITION]

    def rows(path: str, snapshot: Snapshot, columns: list[str]) -> DataFrame:
        parts = [part for part in snapshot.live if day_of(part) in days]
        return read_snapshot(spark, path, snapshot, parts).selectExpr(*columns)

    first, *more = [rows(path, snapshot, cell) for path, snapshot in sources.items()]
    for other in more:
        first = first.unionAll(other)
    there = rows(path, known, ["location_id", f"dates as {PARTITION}"])
    if not share_locations(first, there):
        return set()
    unplaced = first.where("location_id is null").select(PARTITION)
    again = there.join(first.distinct(), cell, "left_semi").select(PARTITION)
    return {row[PARTITION] for row in again.unionAll(unplaced).distinct().collect()}
