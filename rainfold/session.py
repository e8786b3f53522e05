"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Fixed value: how many tables are built at a time.
TABLES_AT_ONCE = 4
T = TypeVar("T")


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results and skew handling rest on.

    The zone turns zone-aware ingestion stamps into plain UTC timestamps. Adaptive execution
    splits hot dates when they are written.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Both are shared by driver and executors; no machine's own folder is ever used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, for the few steps that Spark has no writer for."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders that nothing reads any more."""
    for path in paths:
        at, files = hadoop_path(spark, path)
        files.delete(at, True)


def materialize(
    df: DataFrame, name: str, held: list[str] | None = None, by: str | None = None
) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several outputs need the same rows: it survives lost executors and, unlike a
    cache, takes no executor memory. The path is added to ``held`` for its later removal. ``by`` names
    a column whose values get a folder each.
    """
    path = scratch_path(df.sparkSession, name)
    if held is not None:
        held.append(path)
    df.write.partitionBy(*[by] if by else []).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def concurrently(spark: SparkSession, jobs: dict[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent jobs side by side, so one job's last tasks leave no executors idle."""
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()
        }
        return {name: job.result() for name, job in running.items()}
