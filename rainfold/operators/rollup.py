"""Hours to days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Output column and its aggregate. A sum counts a missing hour as zero, so it is never null.
AGGREGATES = {
    "temperature_2m_max_from_hourly": "max(temperature_2m)",
    "temperature_2m_min_from_hourly": "min(temperature_2m)",
    "temperature_2m_mean_from_hourly": "avg(temperature_2m)",
    "rain_sum_from_hourly": "sum(coalesce(rain, 0d))",
    "precipitation_sum_from_hourly": "sum(coalesce(precipitation, 0d))",
    "snowfall_sum_from_hourly": "sum(coalesce(snowfall, 0d))",
    "wind_speed_10m_max": "max(wind_speed_10m)",
    "wind_speed_10m_mean": "avg(wind_speed_10m)",
    "precip_hours": "count_if(precipitation > 0)",
    "rain_hours": "count_if(rain > 0)",
    "snowfall_hours": "count_if(snowfall > 0)",
    "hourly_latest_ingested_at": "max(ingested_at)",
}


def roll_up_to_days(hourly: DataFrame) -> DataFrame:
    """One row per location and day of hourly readings.

    Every aggregate has a partial form: rows combine before the shuffle, and a location with a
    long history spreads over days.
    """
    return hourly.groupBy("location_id", F.to_date("observed_at").alias("dates")).agg(
        *[F.expr(f"{aggregate} as {name}") for name, aggregate in AGGREGATES.items()]
    )
