"""Tables that are computed date by date from another table, and follow its loads.

A derived table's pointer says which loads of the source each of its dates was computed from. Where
the source's pointer names others now, the date is computed anew; nothing else is read. Both pointers
are small files, so to see that nothing has changed takes no job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from rainfold.operators import snapshots
from rainfold.operators.snapshots import NO_VALUE, Snapshot, read_snapshot


@dataclass(frozen=True)
class Stale:
    """Partition folders of the source that a derived table does not show as they are now."""

    source: Snapshot
    derived: Snapshot | None
    changed: list[str]
    removed: list[str]

    @property
    def days(self) -> set[date | None]:
        return {day_of(part) for part in [*self.changed, *self.removed]}


def day_of(part: str) -> date | None:
    text = part.partition("=")[2]
    return None if text == NO_VALUE else date.fromisoformat(text)


def stale(spark: SparkSession, source_path: str, path: str) -> Stale:
    source, derived = snapshots.current(spark, source_path), snapshots.current(spark, path)
    if source is None:
        raise FileNotFoundError(f"no table at {source_path}")
    known = derived.made_from if derived else {}
    return Stale(
        source,
        derived,
        [part for part, loads in source.live.items() if known.get(part) != loads],
        [part for part in known if part not in source.live],
    )


def replace_days(
    rows: DataFrame, path: str, partition: str, found: Stale
) -> Snapshot:
    """Put ``rows`` in place of the stale days and note what they were computed from."""
    made_from = dict(found.derived.made_from) if found.derived else {}
    for part in found.removed:
        del made_from[part]
    made_from |= {part: found.source.live[part] for part in found.changed}
    return snapshots.replace_table(rows, path, partition, found.days, made_from=made_from)


def follow(
    spark: SparkSession, source_path: str, path: str, partition: str,
    compute: Callable[[DataFrame], DataFrame],
) -> set[date | None]:
    """Bring a derived table up to date; the days that were computed.

    ``compute`` makes its rows from some days of the source. A row's ``partition`` has to be the date
    that its source rows are stored under.
    """
    found = stale(spark, source_path, path)
    if not found.changed and not found.removed and found.derived:
        return set()
    rows = compute(read_snapshot(spark, source_path, found.source, found.changed))
    replace_days(rows, path, partition, found)
    return found.days
