"""Inclusive date ranges."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the upstream archive lags this many days behind today.
ARCHIVE_DELAY_DAYS = 5


@dataclass(frozen=True)
class DateRange:
    start: date
    end: date

    def __post_init__(self):
        if self.start > self.end:
            raise ValueError(f"start {self.start} lies after end {self.end}")

    def covers(self, column: Column) -> Column:
        return column.between(F.lit(self.start), F.lit(self.end))

    @property
    def days(self) -> frozenset[date]:
        count = (self.end - self.start).days + 1
        return frozenset(self.start + timedelta(days=n) for n in range(count))


@dataclass(frozen=True)
class DateSet:
    """Some calendar days: the ones a load touched. Their number is bounded by the calendar."""

    days: frozenset[date]

    def covers(self, column: Column) -> Column:
        return column.isin(sorted(self.days))

    def __or__(self, other: DateSet) -> DateSet:
        return DateSet(self.days | other.days)


def resolve_range(
    today: date,
    lookback_days: int,
    start: str | date | None = None,
    end: str | date | None = None,
) -> DateRange:
    """Both bounds fix the range, none means ``lookback_days`` back from the archive's last day.

    Exactly one bound is an error.
    """
    if (start is None) != (end is None):
        raise ValueError("give both start and end of a fixed range, or neither")
    if start is not None:
        first, last = (
            date.fromisoformat(bound) if isinstance(bound, str) else bound
            for bound in (start, end)
        )
        return DateRange(first, last)
    last = today - timedelta(days=ARCHIVE_DELAY_DAYS)
    return DateRange(last - timedelta(days=lookback_days), last)
