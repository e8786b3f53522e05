"""Text to typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that count as true.
TRUTHY = ("true", "1", "yes", "y", "t")


def truthy(column: Column) -> Column:
    """True for the texts above after trim and lower; everything else, null included, is false."""
    return F.coalesce(F.lower(F.trim(column.cast("string"))).isin(*TRUTHY), F.lit(False))


def lenient_timestamp(column: Column) -> Column:
    """Wall-clock text to a zone-less timestamp; unparsable text becomes null."""
    return column.try_cast("timestamp_ntz")


def lenient_utc_timestamp(column: Column) -> Column:
    """Zone-aware text to the UTC wall clock (session zone is UTC); unparsable becomes null."""
    return column.try_cast("timestamp").cast("timestamp_ntz")


def iso_seconds(column: Column) -> Column:
    """Plain UTC timestamp to ISO text with whole seconds and an explicit zero offset."""
    return F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def ingestion_stamp() -> Column:
    """Now, cut to whole seconds."""
    return F.date_trunc("second", F.current_timestamp()).cast("timestamp_ntz")
