"""Parallel arrays to rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainfold.functions.parsing import (
    ingestion_stamp,
    iso_seconds,
    lenient_timestamp,
    lenient_utc_timestamp,
)
from rainfold.operators.latest import latest_by_key
from rainfold.schemas import DAILY, DAILY_METRICS, HOURLY, HOURLY_METRICS, Readings


def zip_series(time: Column, series: dict[str, Column], time_field: str = "time") -> Column:
    """Array of structs from a time array and value arrays of equal length.

    A null value array keeps the rows and leaves its field null. An array of another length
    than the time array is an error. No times means no rows, whatever the values hold.
    """

    def aligned(name: str, values: Column) -> Column:
        mismatch = F.raise_error(
            F.format_string(
                f"series {name} has %d values for %d times", F.size(values), F.size(time)
            )
        )
        return (
            F.when(values.isNull(), F.array())
            .when(F.size(values) != F.size(time), mismatch)
            .otherwise(values)
        )

    columns = [aligned(name, values).alias(name) for name, values in series.items()]
    return F.when(F.size(time) > 0, F.arrays_zip(time.alias(time_field), *columns))


def explode_series(records: DataFrame, kind: Readings) -> DataFrame:
    """Landing records to bronze rows of one kind, with the record's constants on each row."""
    block = f"payload.{kind.block}"
    zipped = zip_series(
        F.col(f"{block}.time"),
        {metric: F.col(f"{block}.{metric}") for metric in kind.metrics},
        time_field=kind.time_column,
    )
    rows = records.select(
        "location_id",
        lenient_utc_timestamp(F.col("ingested_at")).alias("ingested_at"),
        F.inline(zipped),
    )
    return with_partition_date(
        rows.withColumn(kind.time_column, lenient_timestamp(F.col(kind.time_column))), kind
    ).select(*kind.schema.fieldNames())


def with_partition_date(rows: DataFrame, kind: Readings) -> DataFrame:
    return rows.withColumn("p_date", F.to_date(kind.time_column))


def split_unparsable(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable time, and the rows to quarantine because their time did not parse.

    The partition date is null exactly when the time is, so each half reads its own partitions.
    """
    usable = F.col("p_date").isNotNull()
    return rows.where(usable), rows.where(~usable)


def pack_series(rows: DataFrame, kind: Readings, unique: bool = False) -> DataFrame:
    """Rows to one block of parallel arrays per location and calendar month, in time order.

    The newest row per key goes in, so the month bounds the array length: neither copies of a
    key nor a location with a long history make a group grow. Rows that are ``unique`` by key
    already are not looked through for copies again.
    """
    rows = rows if unique else latest_by_key(rows, kind.keys)
    month = F.trunc("p_date", "month")
    time_format = "yyyy-MM-dd" if kind.block == "daily" else "yyyy-MM-dd'T'HH:mm"
    entry = F.struct(
        F.date_format(kind.time_column, time_format).alias("time"), *kind.metrics
    )
    packed = rows.groupBy("location_id", month.alias("month")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries"),
        F.max("ingested_at").alias("ingested_at"),
    )
    block = F.struct(
        *[F.col("entries")[name].alias(name) for name in ("time", *kind.metrics)]
    )
    return packed.select("location_id", "month", "ingested_at", block.alias(kind.block))


def landing_records(
    hourly: DataFrame, daily: DataFrame, locations: DataFrame, stamped_now: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Landing documents from hourly and daily rows, one per location and month.

    A document has one ingestion stamp: the newest of the rows it holds, or the present moment
    with ``stamped_now``, as for documents that are fetched just now. ``unique`` says that both hold
    each key once.
    """
    blocks = pack_series(hourly, HOURLY, unique).alias("h").join(
        pack_series(daily, DAILY, unique).alias("d"), ["location_id", "month"], "full"
    )
    described = blocks.join(locations, "location_id", "left")
    start = F.date_format("month", "yyyy-MM-dd")
    end = F.date_format(F.last_day("month"), "yyyy-MM-dd")
    place = ("latitude", "longitude")
    newest = F.greatest("h.ingested_at", "d.ingested_at")
    return described.select(
        "location_id",
        "name",
        "country",
        "timezone",
        start.alias("start_date"),
        end.alias("end_date"),
        iso_seconds(ingestion_stamp() if stamped_now else newest).alias("ingested_at"),
        F.struct(*place, "hourly", "daily").alias("payload"),
        F.struct(
            *place,
            "timezone",
            start.alias("start_date"),
            end.alias("end_date"),
            F.lit(",".join(HOURLY_METRICS)).alias("hourly"),
            F.lit(",".join(DAILY_METRICS)).alias("daily"),
        ).alias("request_params"),
    )
