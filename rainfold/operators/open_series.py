"""Blocks of parallel arrays whose variables are not known beforehand.

The fixed schema keeps the metrics it names. Here a block is a map of ``VARIANT`` values, and every key
of it becomes a column: a number where all values of a delivery are numbers, else text. Tables that
take such rows grow by their columns (``load(..., grow=True)``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainfold.functions.parsing import lenient_timestamp, lenient_utc_timestamp
from rainfold.operators.series import with_partition_date, zip_series
from rainfold.schemas import Readings

# The key of a block's times, and how many variables a table can take.
TIME = "time"
MOST_VARIABLES = 2_000
_NUMBERS = re.compile(r"(ARRAY<)?(VOID|BIGINT|DOUBLE|DECIMAL\(\d+,\s?\d+\))>?")


def open_variables(records: DataFrame, kind: Readings) -> dict[str, str]:
    """Name and type, ``double`` or ``string``, of each variable in a kind's blocks, by name.

    One aggregate with a row for each variable and task. Keys that are the record's own columns do not
    count. Keys that differ only in case are an error, since they cannot be columns of one table.
    """
    own = [TIME, *kind.keys, "ingested_at", "p_date"]
    found = (
        records.select(F.explode(f"payload.{kind.block}"))
        .where(~F.col("key").isin(own))
        .groupBy("key")
        .agg(F.expr("schema_of_variant_agg(value)").alias("type"))
        .orderBy("key")
        .limit(MOST_VARIABLES + 1)
        .collect()
    )
    names = [row["key"] for row in found]
    if len(names) > MOST_VARIABLES:
        raise ValueError(f"blocks hold more than {MOST_VARIABLES} variables")
    lower = [name.lower() for name in names]
    clash = sorted(name for name in names if lower.count(name.lower()) > 1 or name.lower() in own)
    if clash:
        raise ValueError(f"variables cannot be told apart by name: {clash}")
    return {
        row["key"]: "double" if _NUMBERS.fullmatch(row["type"]) else "string" for row in found
    }


def _values(block: str, name: str, data_type: str, size: Column) -> Column:
    """A variable's values: its array, or a single value for each time."""
    value = F.col(block)[name]
    listed = F.try_variant_get(value, "$", f"array<{data_type}>")
    single = F.try_variant_get(value, "$", data_type)
    repeated = F.when(single.isNotNull(), F.array_repeat(single, size))
    return F.when(F.schema_of_variant(value).startswith("ARRAY"), listed).otherwise(repeated)


def explode_open(records: DataFrame, kind: Readings, variables: dict[str, str]) -> DataFrame:
    """Landing records to rows with a column for each variable, as ``explode_series`` does.

    An absent or null variable leaves its column null, a single value stands for every time, and an
    array of another length than the times is an error.
    """
    block = f"payload.{kind.block}"
    time = F.try_variant_get(F.col(block)[TIME], "$", "array<string>")
    zipped = zip_series(
        time,
        {name: _values(block, name, data_type, F.size(time)) for name, data_type in variables.items()},
        time_field=kind.time_column,
    )
    rows = records.select(
        "location_id",
        lenient_utc_timestamp(F.col("ingested_at")).alias("ingested_at"),
        F.inline(zipped),
    )
    parsed = rows.withColumn(kind.time_column, lenient_timestamp(F.col(kind.time_column)))
    return with_partition_date(parsed, kind).select(
        *kind.keys, "ingested_at", *[F.col(f"`{name}`") for name in variables], "p_date"
    )
