"""The driver's tables as observations.

Every event is one reading. The daily feed closes its days three hours before midnight, so
some days exist in one source only. Values are multiples of 1/8 or 1/64: double sums are exact
in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.session import prepare

# The driver's tables have fixed columns; naming them saves a job per read.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}

_LOCATION = "concat('loc_', user_id) as location_id"
_TEMPERATURE = "floor(value * 4) / 8 - 10"


def _amount(*types: str) -> str:
    listed = ", ".join(f"'{name}'" for name in types)
    return f"if(event_type in ({listed}), floor(value) / 64, 0d)"


WET = _amount("click", "purchase", "signup")
RAIN = _amount("click", "purchase")
SNOW = _amount("signup")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def bronze_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings; an ``error`` event has no temperature and no precipitation."""

    def measured(expression: str) -> str:
        return f"if(event_type = 'error', null, {expression})"

    return table(spark, sf_dir, "events").selectExpr(
        _LOCATION,
        "cast(date_trunc('hour', ts) as timestamp_ntz) as observed_at",
        "ts as ingested_at",
        f"{measured(_TEMPERATURE)} as temperature_2m",
        "if(event_id % 17 = 0, null, double(event_id % 101)) as relative_humidity_2m",
        f"{measured(WET)} as precipitation",
        f"{measured(RAIN)} as rain",
        f"{measured(SNOW)} as snowfall",
        "event_id % 9 / 8 as snow_depth",
        "double(event_id % 80) as wind_speed_10m",
        "to_date(ts) as p_date",
    )


def bronze_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily feed; each day is delivered twice and the second, unshifted delivery is newer."""
    readings = table(spark, sf_dir, "events").selectExpr(
        _LOCATION,
        "to_date(ts + interval 3 hours) as p_date",
        f"{_TEMPERATURE} as temperature",
        f"{WET} as wet",
        f"{RAIN} as rain",
        f"{SNOW} as snow",
    )
    days = readings.groupBy("location_id", "p_date").agg(
        *map(
            F.expr,
            (
                "max(temperature) as hottest",
                "min(temperature) as temperature_2m_min",
                "avg(temperature) as temperature_2m_mean",
                "sum(wet) as precipitation_sum",
                "sum(rain) as rain_sum",
                "sum(snow) as snowfall_sum",
                "count(*) as n",
            ),
        )
    )
    return days.selectExpr("*", "explode(array(0, 1)) as delivery").selectExpr(
        "location_id",
        "cast(p_date as timestamp_ntz) as date",
        "cast(date_add(p_date, delivery) as timestamp_ntz) as ingested_at",
        "hottest + delivery / 2 - 0.5d as temperature_2m_max",
        "temperature_2m_min",
        "temperature_2m_mean",
        "rain_sum",
        "precipitation_sum",
        "snowfall_sum",
        "if(day(p_date) % 5 = 0, null, n * 600d) as sunshine_duration",
        "p_date",
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a location list: all columns text except the coordinates."""
    return table(spark, sf_dir, "nation").selectExpr(
        "concat('loc_', n_nationkey) as location_id",
        "n_name as name",
        "concat('R', n_regionkey) as state",
        "'XX' as country",
        "double(n_nationkey - 12) as latitude",
        "double(n_nationkey * 7 - 90) as longitude",
        "'UTC' as timezone",
        "array(' TRUE ', 'yes', '0', 'T', 'off', null, '1')[n_nationkey % 7] as is_active",
    )
