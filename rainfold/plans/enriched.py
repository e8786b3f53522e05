"""Labelled hourly readings, and the daily feed beside its hourly rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainfold.functions.bands import band_columns, flag_columns
from rainfold.schemas import DAILY_METRICS

_LINEAGE = {"ingested_at": "daily_ingested_at", "p_date": "daily_p_date"}
_FROM_HOURLY = (
    "temperature_2m_max_from_hourly",
    "temperature_2m_min_from_hourly",
    "temperature_2m_mean_from_hourly",
    "rain_sum_from_hourly",
    "precipitation_sum_from_hourly",
    "snowfall_sum_from_hourly",
    "wind_speed_10m_max",
    "wind_speed_10m_mean",
    "precip_hours",
    "rain_hours",
    "snowfall_hours",
    "hourly_latest_ingested_at",
)
# Gap column and the daily metric whose feed value minus hourly value it holds.
GAPS = {
    "diff_temp_max_api_vs_hourly": "temperature_2m_max",
    "diff_temp_min_api_vs_hourly": "temperature_2m_min",
    "diff_precip_api_vs_hourly": "precipitation_sum",
}


def hourly_enriched(staged: DataFrame) -> DataFrame:
    """Staged hourly readings with four bands and three flags; no shuffle."""
    return staged.select("*", *band_columns(), *flag_columns())


def pair_daily(
    daily: DataFrame, rollup: DataFrame, how: str = "full", marked: bool = False
) -> DataFrame:
    """The daily feed and the rollup side by side, matched on location and day.

    Every daily table is a projection of this one join. ``day`` is the date of either side,
    ``dates`` the feed's own timestamp, and ``in_feed`` marks rows the feed has. With ``marked`` there is
    what ``rollup_of_pairs`` needs; it takes no shuffle of its own, since the join groups alike.
    """
    feed = daily.withColumnsRenamed(_LINEAGE).selectExpr(
        "*", "to_date(dates) as day", "true as in_feed"
    )
    hours = rollup.withColumnRenamed("dates", "day")
    if not marked:
        return feed.join(hours, ["location_id", "day"], how)
    first = "row_number() over (partition by location_id, day order by dates) = 1 as first_of_day"
    pairs = feed.selectExpr("*", first).join(
        hours.selectExpr("*", "true as in_hours"), ["location_id", "day"], how
    )
    in_rollup = F.expr("in_hours is not null and coalesce(first_of_day, true)")
    return pairs.withColumn("in_rollup", in_rollup).drop("first_of_day", "in_hours")


def rollup_of_pairs(pairs: DataFrame) -> DataFrame:
    """The rollup that marked pairs were made of, each of its rows once, however many rows of the feed
    it is paired with."""
    kept = pairs.where("in_rollup").withColumn("dates", F.col("day"))
    return kept.select("location_id", "dates", *_FROM_HOURLY)


# SQL: the feed's row bears its day at midnight, as the rollup does; only such rows compare.
AT_MIDNIGHT = "dates = cast(day as timestamp_ntz)"


def daily_enriched(pairs: DataFrame) -> DataFrame:
    """Rows the feed has, with both sources' values and their differences.

    A feed row that is not at midnight has no counterpart among the hourly days.
    """
    return pairs.where("in_feed").selectExpr(
        "location_id",
        "dates",
        *_LINEAGE.values(),
        *DAILY_METRICS,
        *[f"if({AT_MIDNIGHT}, {column}, null) as {column}" for column in _FROM_HOURLY],
        *[
            f"if({AT_MIDNIGHT}, {metric} - {metric}_from_hourly, null) as {gap}"
            for gap, metric in GAPS.items()
        ],
    )
