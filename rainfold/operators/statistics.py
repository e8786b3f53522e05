"""Figures of a table's columns, stored for each date and kept up to date by its loads.

A date's row holds the number of rows and of distinct keys, and of each column the least and largest
value and the number of nulls. Figures of the whole table are sums, minima and maxima over dates, since
a key lies in one date; they read no row of the table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.operators.derived import follow
from rainfold.operators.snapshots import read_table
from rainfold.operators.tables import PARTITION
from rainfold.schemas import Readings


def figures_by_date(rows: DataFrame, kind: Readings) -> DataFrame:
    """One row per date. Each aggregate combines before the shuffle; keys are counted once each."""
    columns = [c for c in rows.columns if c != PARTITION]
    keys = [*kind.keys, PARTITION]
    per_key = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.struct(
                F.min(f"`{c}`").alias("least"),
                F.max(f"`{c}`").alias("most"),
                F.count_if(F.col(f"`{c}`").isNull()).alias("nulls"),
            ).alias(f"of_{c}")
            for c in columns
            if c not in kind.keys
        ],
    )
    of_keys = [
        F.struct(
            F.min(c).alias("least"),
            F.max(c).alias("most"),
            F.sum(F.when(F.col(c).isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        ).alias(f"of_{c}")
        for c in kind.keys
    ]
    of_others = [
        F.struct(
            F.min(f"`of_{c}`.least").alias("least"),
            F.max(f"`of_{c}`.most").alias("most"),
            F.sum(f"`of_{c}`.nulls").alias("nulls"),
        ).alias(f"of_{c}")
        for c in columns
        if c not in kind.keys
    ]
    return per_key.groupBy(PARTITION).agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"), *of_keys, *of_others
    )


def follow_figures(
    spark: SparkSession, table_path: str, path: str, kind: Readings
) -> set[date | None]:
    """Bring the stored figures up to date; only dates that a load has changed are read."""
    return follow(
        spark, table_path, path, PARTITION, lambda rows: figures_by_date(rows, kind)
    )


def column_figures(spark: SparkSession, path: str, kind: Readings) -> DataFrame:
    """One row per column of the whole table: least and largest value as text, and nulls."""
    stored = read_table(spark, path)
    names = [c.removeprefix("of_") for c in stored.columns if c.startswith("of_")]
    whole = stored.agg(
        *[
            F.struct(
                F.min(f"`of_{c}`.least").cast("string").alias("least"),
                F.max(f"`of_{c}`.most").cast("string").alias("most"),
                F.coalesce(F.sum(f"`of_{c}`.nulls"), F.lit(0)).alias("nulls"),
            ).alias(c)
            for c in names
        ]
    )
    listed = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("of")) for c in names]
    )
    return whole.select(F.inline(listed)).select("column", "of.least", "of.most", "of.nulls")


def key_figures(spark: SparkSession, path: str) -> DataFrame:
    """One row, as ``duplicate_count`` gives it for the table."""
    return read_table(spark, path).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum("distinct_keys"), F.lit(0)).alias("rows_kept"),
        F.coalesce(F.sum(F.col("rows") - F.col("distinct_keys")), F.lit(0)).alias("duplicates"),
    )


def newest(spark: SparkSession, path: str, column: str = "ingested_at") -> DataFrame:
    """The table's ``column`` as one row with its largest value, for ``freshness``."""
    return read_table(spark, path).select(F.col(f"of_{column}.most").alias(column))
