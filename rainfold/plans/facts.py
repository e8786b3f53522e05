"""Presentation tables: the location dimension and the daily facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainfold.functions.parsing import truthy
from rainfold.functions.reconciliation import completeness, provenance, reconciliation_status
from rainfold.plans.enriched import AT_MIDNIGHT
from rainfold.schemas import DAILY_METRICS

TEMPERATURES = ("temperature_2m_max", "temperature_2m_min", "temperature_2m_mean")
SUMS = ("rain_sum", "precipitation_sum", "snowfall_sum")
WINDS = ("wind_speed_10m_max", "wind_speed_10m_mean")
HOUR_COUNTS = ("precip_hours", "rain_hours", "snowfall_hours")


def dim_locations(locations: DataFrame) -> DataFrame:
    """All locations, inactive ones too; an unknown activity stays null."""
    active = F.when(F.col("is_active").isNotNull(), truthy(F.col("is_active")))
    return locations.select(
        "location_id",
        F.col("name").alias("location_name"),
        "state",
        "country",
        "latitude",
        "longitude",
        "timezone",
        active.alias("is_active"),
    )


def fct_daily_api(daily: DataFrame) -> DataFrame:
    """Daily fact as the feed states it."""
    return daily.selectExpr("location_id", "to_date(dates) as dates", *DAILY_METRICS)


def fct_daily_hourly(rollup: DataFrame) -> DataFrame:
    """Daily fact derived from hourly readings."""
    return rollup.selectExpr(
        "location_id",
        "dates",
        *[f"{metric}_from_hourly as {metric}" for metric in TEMPERATURES + SUMS],
        *WINDS,
        *HOUR_COUNTS,
    )


def _preferred(metric: str) -> str:
    return f"coalesce({metric}_from_hourly, {metric})"


def _source(metric: str) -> str:
    return provenance(f"{metric}_from_hourly", metric)


def fct_daily(pairs: DataFrame) -> DataFrame:
    """Canonical daily fact: hourly-derived values first, the feed's otherwise, with provenance.

    Sunshine comes from the feed only, wind and hour counts from hourly readings only.
    """
    return pairs.selectExpr(
        "location_id",
        "day as dates",
        *[f"{_preferred(metric)} as {metric}" for metric in TEMPERATURES + SUMS],
        "sunshine_duration",
        *WINDS,
        *HOUR_COUNTS,
        f"{_source('temperature_2m_max')} as temperature_source",
        f"{_source('precipitation_sum')} as precipitation_source",
        f"{provenance(None, 'sunshine_duration')} as sunshine_source",
    )


def fct_daily_quality(pairs: DataFrame) -> DataFrame:
    """Completeness and agreement of the two sources per canonical row.

    A row is reconciled with the feed row that bears its date at midnight. With one feed row per
    location and day, which the declared checks assert, that row is in the same pair, so
    neither source is joined a second time. Days without a feed row have no gaps.
    """

    def gap(metric: str) -> str:
        difference = f"abs({metric} - {metric}_from_hourly)"
        return f"if({AT_MIDNIGHT}, {difference}, null)"

    # Fixed value: the eight metrics that count towards completeness.
    scored = [_preferred(metric) for metric in TEMPERATURES + SUMS] + [
        "sunshine_duration",
        "wind_speed_10m_max",
    ]
    status = reconciliation_status("abs_diff_temp_max", "abs_diff_temp_min", "abs_diff_precip")
    return pairs.selectExpr(
        "location_id",
        "day as dates",
        f"{completeness(scored)} as completeness_score",
        f"{gap('temperature_2m_max')} as abs_diff_temp_max",
        f"{gap('temperature_2m_min')} as abs_diff_temp_min",
        f"{gap('precipitation_sum')} as abs_diff_precip",
        "precip_hours",
    ).selectExpr("*", f"{status} as reconciliation_status")
