"""Intermediate tables in the folder that the cluster's driver and executors share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


# Fixed value: rows in an Arrow batch. Texts are large rows; both sides of a worker hold whole batches.
BATCH_ROWS = 1_000
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the batches that go to Python; workers find this package where the driver found it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` and read it back: cuts the lineage, survives lost executors.

    The table's path is added to ``paths`` for its later removal.
    """
    path = shared_path(df.sparkSession, name)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove intermediate tables that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def row_key(text: str = "text") -> str:
    """SQL for 128 bits that tell apart rows which repeat a doc_id with another text."""
    return f"struct(xxhash64({text}) as a, xxhash64({text}, length({text})) as b)"
