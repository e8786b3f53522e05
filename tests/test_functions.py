from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rainfold.functions.bands import BANDINGS, band_columns, flag_columns
from rainfold.functions.dates import DateRange, resolve_range
from rainfold.functions.parsing import (
    ingestion_stamp,
    iso_seconds,
    lenient_timestamp,
    lenient_utc_timestamp,
    truthy,
)
from rainfold.functions.reconciliation import completeness, provenance, reconciliation_status
from tests.helpers import hourly_rows


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(value,) for value in values], f"x {kind}")


def outcomes(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_truthy_text(spark):
    texts = ["true", " TRUE ", "1", "Yes", "y", "T", "false", "0", "on", "", None]
    assert outcomes(one_column(spark, texts), truthy(F.col("x"))) == [True] * 6 + [False] * 5


def test_truthy_of_other_types(spark):
    assert outcomes(one_column(spark, [1, 0], "int"), truthy(F.col("x"))) == [True, False]
    assert outcomes(one_column(spark, [True, None], "boolean"), truthy(F.col("x"))) == [True, False]


def test_lenient_timestamps(spark):
    df = one_column(spark, ["2024-01-01T05:00", "2024-01-01", "noise", None])
    assert outcomes(df, lenient_timestamp(F.col("x"))) == [
        datetime(2024, 1, 1, 5), datetime(2024, 1, 1), None, None]


def test_wall_clock_survives_a_daylight_saving_gap(spark):
    # This local time does not exist in zones that switch that night.
    spark.conf.set("spark.sql.session.timeZone", "America/Vancouver")
    try:
        df = one_column(spark, ["2024-03-10T02:30"])
        assert outcomes(df, lenient_timestamp(F.col("x"))) == [datetime(2024, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_utc_stamps_normalize(spark):
    df = one_column(spark, ["2024-01-01T05:00:00+00:00", "2024-01-01T05:00:00+02:00", "?"])
    assert outcomes(df, lenient_utc_timestamp(F.col("x"))) == [
        datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 3), None]


def test_iso_seconds_round_trip(spark):
    df = one_column(spark, ["2024-01-01T05:00:07+00:00"])
    assert outcomes(df, iso_seconds(lenient_utc_timestamp(F.col("x")))) == [
        "2024-01-01T05:00:07+00:00"]


def test_ingestion_stamp_has_whole_seconds(spark):
    stamp = spark.range(1).select(ingestion_stamp().alias("s"))
    assert stamp.schema["s"].dataType.simpleString() == "timestamp_ntz"
    assert stamp.first()["s"].microsecond == 0


@pytest.mark.parametrize(
    "band, values, labels",
    [
        ("temp_bucket", [-3, 0, 0.1, 15, 15.1, 25, 25.1],
         ["freezing", "freezing", "cold", "cold", "mild", "mild", "hot"]),
        ("humidity_bucket", [30, 31, 50, 60, 70, 71],
         ["dry", "mild", "mild", "moderately humid", "humid", "very humid"]),
        ("wind_bucket", [19, 38, 61, 62], ["light", "moderate", "strong", "gale"]),
        ("precipitation_bucket", [0, 0.05, 0.1, 2.5, 7.5, 30, 31],
         ["no precipitation", "no precipitation", "very light", "very light", "light",
          "moderate", "heavy"]),
    ],
)
def test_band_edges(spark, band, values, labels):
    df = one_column(spark, [float(v) for v in values] + [None], "double")
    banding = BANDINGS[band]
    df = df.withColumnRenamed("x", banding.metric)
    assert outcomes(df, banding.column()) == labels + [None]


def test_flags_keep_nulls_and_disagree_with_the_lowest_band(spark):
    df = hourly_rows(
        spark,
        {"observed_at": "2024-01-01T00:00", "precipitation": 0.05, "rain": 0.0},
    ).select(*band_columns(), *flag_columns())
    row = df.first()
    assert row["precipitation_bucket"] == "no precipitation"
    assert (row["is_precipitating"], row["is_rain"], row["is_snowfall"]) == (True, False, None)


def test_range_rules():
    today = date(2024, 3, 10)
    assert resolve_range(today, 7) == DateRange(date(2024, 2, 27), date(2024, 3, 5))
    fixed = resolve_range(today, 7, "2024-01-01", date(2024, 1, 2))
    assert fixed == DateRange(date(2024, 1, 1), date(2024, 1, 2))
    with pytest.raises(ValueError, match="both"):
        resolve_range(today, 7, start="2024-01-01")
    with pytest.raises(ValueError, match="both"):
        resolve_range(today, 7, end="2024-01-01")
    with pytest.raises(ValueError, match="after"):
        resolve_range(today, 7, "2024-01-02", "2024-01-01")


def test_range_covers_both_ends(spark):
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-04')) as d")
    kept = df.where(DateRange(date(2024, 1, 2), date(2024, 1, 3)).covers(F.col("d")))
    assert [row.d.day for row in kept.collect()] == [2, 3]


@pytest.mark.parametrize(
    "present, score", [(0, 0.0), (1, 0.13), (3, 0.38), (5, 0.63), (7, 0.88), (8, 1.0)]
)
def test_completeness_rounds_half_up(spark, present, score):
    metrics = ["1d"] * present + ["cast(null as double)"] * (8 - present)
    df = spark.range(1).selectExpr(f"{completeness(metrics)} as s")
    assert df.schema["s"].dataType.simpleString() == "decimal(13,2)"
    assert float(df.first()["s"]) == score


@pytest.mark.parametrize(
    "gaps, status",
    [
        ((0.0, 0.0, None), "missing_hourly"),
        ((2.0, 2.0, 5.0), "ok"),
        ((None, None, 0.0), "ok"),
        ((2.1, 0.0, 0.0), "warning"),
        ((0.0, 2.1, 0.0), "warning"),
        ((0.0, 0.0, 5.1), "warning"),
    ],
)
def test_reconciliation_status(spark, gaps, status):
    df = spark.createDataFrame([gaps], "hi double, lo double, wet double")
    assert df.selectExpr(reconciliation_status("hi", "lo", "wet")).first()[0] == status


def test_provenance(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (None, None)], "h double, f double")
    assert outcomes(df, F.expr(provenance("h", "f"))) == ["hourly_derived", "api_daily", None]
    assert outcomes(df, F.expr(provenance(None, "f"))) == ["api_daily", "api_daily", None]
