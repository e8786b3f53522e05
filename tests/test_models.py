import pytest
from pyspark.sql import functions as F

from rainfold.functions.dates import DateRange
from rainfold.operators.rollup import roll_up_to_days
from rainfold.plans.enriched import daily_enriched, hourly_enriched, pair_daily
from rainfold.plans.facts import fct_daily, fct_daily_api, fct_daily_hourly, fct_daily_quality
from rainfold.plans.staging import stg_daily, stg_hourly
from tests.helpers import daily_rows, hourly_rows, records, ts


def pairs(hourly, daily, how="full", dates=None):
    rollup = roll_up_to_days(hourly_enriched(stg_hourly(hourly, dates)))
    return pair_daily(stg_daily(daily, dates), rollup, how)


def day(number):
    return ts(f"2024-01-{number:02}").date()


@pytest.fixture(scope="module")
def hourly(spark):
    return hourly_rows(
        spark,
        {"observed_at": "2024-01-01T22:00", "temperature_2m": 4.0, "precipitation": 1.0,
         "rain": 1.0, "wind_speed_10m": 10.0},
        {"observed_at": "2024-01-01T23:00", "temperature_2m": 8.0, "precipitation": None,
         "wind_speed_10m": 20.0, "ingested_at": "2024-02-03"},
        {"observed_at": "2024-01-02T00:00", "temperature_2m": None, "precipitation": None},
        {"observed_at": "2024-01-04T00:00", "temperature_2m": 1.0, "precipitation": 9.0},
    )


@pytest.fixture(scope="module")
def daily(spark):
    return daily_rows(
        spark,
        {"date": "2024-01-01", "temperature_2m_max": 11.0, "temperature_2m_min": 4.0,
         "precipitation_sum": 1.0, "sunshine_duration": 60.0},
        {"date": "2024-01-02", "temperature_2m_max": 5.0, "temperature_2m_min": 1.0,
         "precipitation_sum": 3.0},
        {"date": "2024-01-03", "temperature_2m_max": 5.0},
    )


def test_rollup_splits_at_midnight_and_counts_missing_as_zero(hourly):
    rolled = roll_up_to_days(hourly)
    assert records(
        rolled, "dates", "temperature_2m_max_from_hourly", "temperature_2m_min_from_hourly",
        "temperature_2m_mean_from_hourly", "precipitation_sum_from_hourly",
        "rain_sum_from_hourly", "wind_speed_10m_max", "wind_speed_10m_mean", "precip_hours",
        "snowfall_hours", "hourly_latest_ingested_at",
    ) == [
        (day(1), 8.0, 4.0, 6.0, 1.0, 1.0, 20.0, 15.0, 1, 0, ts("2024-02-03")),
        (day(2), None, None, None, 0.0, 0.0, None, None, 0, 0, ts("2024-02-01")),
        (day(4), 1.0, 1.0, 1.0, 9.0, 0.0, None, None, 1, 0, ts("2024-02-01")),
    ]
    assert dict(rolled.dtypes)["precip_hours"] == "bigint"


def test_enriched_days_follow_the_feed(hourly, daily):
    enriched = daily_enriched(pairs(hourly, daily))
    assert records(
        enriched, "dates", "diff_temp_max_api_vs_hourly", "diff_precip_api_vs_hourly",
        "daily_p_date",
    ) == [
        (ts("2024-01-01"), 3.0, 0.0, day(1)),
        (ts("2024-01-02"), None, 3.0, day(2)),
        (ts("2024-01-03"), None, None, day(3)),
    ]
    assert len(enriched.columns) == 26
    assert records(enriched) == records(daily_enriched(pairs(hourly, daily, "left")))


def test_canonical_fact_prefers_hourly_and_names_sources(hourly, daily):
    fact = fct_daily(pairs(hourly, daily))
    assert records(
        fact, "dates", "temperature_2m_max", "temperature_source", "precipitation_sum",
        "precipitation_source", "sunshine_duration", "sunshine_source",
    ) == [
        (day(1), 8.0, "hourly_derived", 1.0, "hourly_derived", 60.0, "api_daily"),
        # Hours without precipitation sum to zero, which hides the feed's value.
        (day(2), 5.0, "api_daily", 0.0, "hourly_derived", None, None),
        (day(3), 5.0, "api_daily", None, None, None, None),
        (day(4), 1.0, "hourly_derived", 9.0, "hourly_derived", None, None),
    ]
    assert fact.columns[:9] == [
        "location_id", "dates", "temperature_2m_max", "temperature_2m_min",
        "temperature_2m_mean", "rain_sum", "precipitation_sum", "snowfall_sum",
        "sunshine_duration"]


def test_quality(hourly, daily):
    quality = fct_daily_quality(pairs(hourly, daily))
    assert records(
        quality.withColumn("completeness_score", F.col("completeness_score").cast("double")),
        "dates", "completeness_score", "abs_diff_temp_max", "abs_diff_precip", "precip_hours",
        "reconciliation_status",
    ) == [
        (day(1), 1.0, 3.0, 0.0, 1, "warning"),
        (day(2), 0.63, None, 3.0, 0, "ok"),
        (day(3), 0.13, None, None, None, "missing_hourly"),
        # No feed row: the label is broader than its name.
        (day(4), 0.75, None, None, 1, "missing_hourly"),
    ]


def test_missing_feed_precipitation_is_labelled_missing(spark, hourly):
    feed = daily_rows(spark, {"date": "2024-01-01", "temperature_2m_max": 8.0})
    quality = fct_daily_quality(pairs(hourly, feed)).where("dates = date'2024-01-01'")
    assert quality.first()["reconciliation_status"] == "missing_hourly"


def joined_twice(hourly, daily):
    """The quality fact by its definition: canonical fact left-joined to the enriched days."""
    base = fct_daily(pairs(hourly, daily)).alias("b")
    recon = daily_enriched(pairs(hourly, daily)).select(
        F.col("location_id").alias("l"), F.col("dates").alias("d"),
        F.abs("diff_temp_max_api_vs_hourly").alias("gap_max"),
        F.abs("diff_temp_min_api_vs_hourly").alias("gap_min"),
        F.abs("diff_precip_api_vs_hourly").alias("gap_precip"))
    return base.join(
        recon,
        (F.col("location_id") == F.col("l"))
        & (F.col("dates").cast("timestamp_ntz") == F.col("d")),
        "left",
    ).select("location_id", "dates", "gap_max", "gap_min", "gap_precip", "precip_hours")


def test_one_join_equals_two(hourly, daily):
    quality = fct_daily_quality(pairs(hourly, daily)).select(
        "location_id", "dates", "abs_diff_temp_max", "abs_diff_temp_min", "abs_diff_precip",
        "precip_hours")
    assert records(quality) == records(joined_twice(hourly, daily))


def test_feed_row_off_midnight_has_no_gaps(spark, hourly):
    feed = daily_rows(
        spark, {"date": "2024-01-01T06:00", "precipitation_sum": 1.0, "temperature_2m_max": 8.0})
    assert records(fct_daily_quality(pairs(hourly, feed)), "dates", "abs_diff_precip") == [
        (day(1), None), (day(2), None), (day(4), None)]


def test_single_source_facts(hourly, daily):
    assert records(fct_daily_api(stg_daily(daily)), "dates", "precipitation_sum") == [
        (day(1), 1.0), (day(2), 3.0), (day(3), None)]
    fact = fct_daily_hourly(roll_up_to_days(stg_hourly(hourly)))
    assert records(fact, "dates", "precipitation_sum", "precip_hours") == [
        (day(1), 1.0, 1), (day(2), 0.0, 0), (day(4), 9.0, 1)]


def test_range_before_equals_range_after(hourly, daily):
    dates = DateRange(day(2), day(3))
    before = fct_daily(pairs(hourly, daily, dates=dates))
    after = fct_daily(pairs(hourly, daily)).where(dates.covers(F.col("dates")))
    assert records(before) == records(after)
    assert before.count() == 2


def test_rows_without_location_stay_apart(spark):
    hours = hourly_rows(spark, {"observed_at": "2024-01-01T00:00", "location_id": None})
    feed = daily_rows(spark, {"date": "2024-01-01", "location_id": None})
    assert fct_daily(pairs(hours, feed)).count() == 2
