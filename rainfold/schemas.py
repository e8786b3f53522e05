"""Column lists, struct types and keys of every table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Metric names as delivered by the upstream service.
HOURLY_METRICS = (
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "rain",
    "snowfall",
    "snow_depth",
    "wind_speed_10m",
)
DAILY_METRICS = (
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "rain_sum",
    "precipitation_sum",
    "snowfall_sum",
    "sunshine_duration",
)

# Columns a location list must have.
LOCATION_COLUMNS = (
    "location_id",
    "name",
    "state",
    "country",
    "latitude",
    "longitude",
    "timezone",
    "is_active",
)


def _fields(names, data_type) -> list[T.StructField]:
    return [T.StructField(name, data_type) for name in names]


def _series(metrics) -> T.StructType:
    return T.StructType(
        _fields(["time"], T.ArrayType(T.StringType()))
        + _fields(metrics, T.ArrayType(T.DoubleType()))
    )


LANDING = T.StructType(
    _fields(
        ["location_id", "name", "country", "timezone", "start_date", "end_date", "ingested_at"],
        T.StringType(),
    )
    + [
        T.StructField(
            "payload",
            T.StructType(
                _fields(["latitude", "longitude"], T.DoubleType())
                + [
                    T.StructField("hourly", _series(HOURLY_METRICS)),
                    T.StructField("daily", _series(DAILY_METRICS)),
                ]
            ),
        ),
        T.StructField(
            "request_params",
            T.StructType(
                _fields(["latitude", "longitude"], T.DoubleType())
                + _fields(
                    ["timezone", "start_date", "end_date", "hourly", "daily"], T.StringType()
                )
            ),
        ),
    ]
)


def _open(schema: T.StructType) -> T.StructType:
    """The landing schema with each kind's block as a map of whatever it holds."""
    block = T.MapType(T.StringType(), T.VariantType())
    fields = []
    for field in schema:
        if field.name == "payload":
            place = [f for f in field.dataType if not isinstance(f.dataType, T.StructType)]
            held = T.StructType([*place, *_fields(["hourly", "daily"], block)])
            field = T.StructField(field.name, held)
        fields.append(field)
    return T.StructType(fields)


OPEN_LANDING = _open(LANDING)


@dataclass(frozen=True)
class Readings:
    """One kind of reading: its block in the landing record, its time column and its metrics.

    ``p_date`` is the date of the time column and so a function of the key. Partition pruning
    before the dedup and partition-wise upserts both rest on that.
    """

    block: str
    time_column: str
    metrics: tuple[str, ...]

    @property
    def keys(self) -> tuple[str, str]:
        return ("location_id", self.time_column)

    @property
    def schema(self) -> T.StructType:
        """Bronze columns; the partition column comes last, as Spark writes it."""
        return T.StructType(
            [
                T.StructField("location_id", T.StringType()),
                T.StructField(self.time_column, T.TimestampNTZType()),
                T.StructField("ingested_at", T.TimestampNTZType()),
            ]
            + _fields(self.metrics, T.DoubleType())
            + [T.StructField("p_date", T.DateType())]
        )


HOURLY = Readings("hourly", "observed_at", HOURLY_METRICS)
DAILY = Readings("daily", "date", DAILY_METRICS)
