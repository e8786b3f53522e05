"""Bronze to typed, deduplicated readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainfold.functions.dates import DateRange
from rainfold.operators.latest import latest_by_key, latest_of_loaded
from rainfold.schemas import DAILY, HOURLY, Readings


def typed(bronze: DataFrame, kind: Readings, dates: DateRange | None = None) -> DataFrame:
    """Fixed column list and types; the daily feed's ``date`` becomes ``dates``.

    ``dates`` limits the partitions read. It applies before the dedup, where it still reaches
    the scan, and changes no result because ``p_date`` is a function of the key.
    """
    if dates is not None:
        bronze = bronze.where(dates.covers(F.col("p_date")))
    types = {
        "location_id": "string",
        kind.time_column: "timestamp_ntz",
        "ingested_at": "timestamp_ntz",
        "p_date": "date",
    } | dict.fromkeys(kind.metrics, "double")
    return bronze.selectExpr(
        *[
            f"cast({name} as {data_type}) as {'dates' if name == 'date' else name}"
            for name, data_type in types.items()
        ]
    )


def stg_hourly(
    bronze: DataFrame, dates: DateRange | None = None, loaded: bool = False
) -> DataFrame:
    """One row per (location_id, observed_at); ``loaded`` says that loads made the table."""
    newest = latest_of_loaded if loaded else latest_by_key
    return newest(typed(bronze, HOURLY, dates), ["location_id", "observed_at"])


def stg_daily(
    bronze: DataFrame, dates: DateRange | None = None, loaded: bool = False
) -> DataFrame:
    """One row per (location_id, dates); ``loaded`` says that loads made the table."""
    newest = latest_of_loaded if loaded else latest_by_key
    return newest(typed(bronze, DAILY, dates), ["location_id", "dates"])
