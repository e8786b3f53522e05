"""The daily facts from tables that are stored in the order they are needed in.

Bronze tables are kept in the session catalog, bucketed by location and day. Dedup, rollup and the
join of both sources all work within a location and day, so that no step from bronze to fact moves a
row to another task. A location with a long history spreads over its days; a bucket holds many cells of
a location and day, each bounded by the hours of a day and the copies of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.operators.latest import latest_by_key
from rainfold.operators.rollup import AGGREGATES
from rainfold.plans.staging import typed
from rainfold.schemas import DAILY, HOURLY, Readings

CELL = ("location_id", "p_date")


def save_bucketed(rows: DataFrame, table: str, buckets: int) -> None:
    """Replace the catalog table ``table`` by ``rows``, sorted within each of ``buckets`` files.

    One shuffle when the table is written saves those of each later run. Tasks write whole buckets, so
    there are as many files as buckets.
    """
    (
        rows.repartition(buckets, *CELL)
        .write.mode("overwrite")
        .bucketBy(buckets, *CELL)
        .sortBy(*CELL)
        .saveAsTable(table)
    )


def _latest(spark: SparkSession, table: str, kind: Readings) -> DataFrame:
    """One row per key. The day is a function of the key, so naming it changes no result."""
    time = "dates" if kind is DAILY else kind.time_column
    return latest_by_key(typed(spark.table(table), kind), ["location_id", time], within=["p_date"])


def pair_daily(spark: SparkSession, hourly_table: str, daily_table: str) -> DataFrame:
    """The pairs of ``enriched.pair_daily``, without an exchange."""
    days = _latest(spark, hourly_table, HOURLY).groupBy(*CELL).agg(
        *[F.expr(f"{aggregate} as {name}") for name, aggregate in AGGREGATES.items()]
    )
    feed = _latest(spark, daily_table, DAILY).withColumnRenamed("ingested_at", "daily_ingested_at")
    feed = feed.selectExpr("*", "p_date as daily_p_date", "true as in_feed")
    return feed.join(days, list(CELL), "full").withColumnRenamed("p_date", "day")
