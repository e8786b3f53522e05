"""The location list."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.functions.parsing import truthy
from rainfold.operators.guards import require_columns
from rainfold.schemas import LOCATION_COLUMNS


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, matched by column name; coordinates become doubles."""
    try:
        # Read as text: a given schema would be matched by position, not by name. Without column
        # pruning a row with too many fields fails whatever columns a query asks for.
        text = (
            spark.read.option("header", True)
            .option("mode", "FAILFAST")
            .option("columnPruning", False)
            .csv(path)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no location list at {path}: {error.getMessage()}") from error
    require_columns(text, LOCATION_COLUMNS, f"location list {path}")
    return text.withColumns(
        {
            "latitude": F.col("latitude").cast("double"),
            "longitude": F.col("longitude").cast("double"),
        }
    )


def active_locations(locations: DataFrame) -> DataFrame:
    """Active rows; an error when there are none or one of them has no coordinates."""
    require_columns(locations, LOCATION_COLUMNS, "location list")
    active = locations.withColumn("is_active", truthy(F.col("is_active"))).where("is_active")
    nowhere = F.col("latitude").isNull() | F.col("longitude").isNull()
    try:
        summary = active.agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_or(nowhere), F.lit(False)).alias("bad")
        ).first()
    except (PySparkException, Py4JJavaError) as error:
        # Other failures, a lost executor for one, are not about the list.
        if "MALFORMED_RECORD_IN_PARSING" not in str(error) and "FAILED_READ_FILE" not in str(error):
            raise
        raise ValueError(
            "the location list did not parse; a field with a comma in it must be quoted"
        ) from error
    if summary["n"] == 0:
        raise ValueError("no active location; set is_active to true in at least one row")
    if summary["bad"]:
        raise ValueError("an active location lacks its latitude or longitude")
    return active
