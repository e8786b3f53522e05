"""Landing documents: one JSON object per line."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainfold.schemas import LANDING

# Lines files by their suffixes, compressed or not, and an age that no file reaches.
LINE_FILES = "*.{json,jsonl,json.gz,jsonl.gz}"
ANY_AGE = "100000d"
_CORRUPT = "malformed"


def _options(reader, schema: T.StructType, mode: str):
    return (
        reader.schema(schema)
        .option("mode", mode)
        .option("pathGlobFilter", LINE_FILES)
        .option("recursiveFileLookup", True)
    )


def require_landing(spark: SparkSession, path: str) -> None:
    """An error when no file matches; lists files but reads none of them."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", LINE_FILES)
            .option("recursiveFileLookup", True)
            .load(path)
            .select("path")
        )
        found = not files.isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no landing folder at {path}") from error
    if not found:
        raise FileNotFoundError(f"no {LINE_FILES} file under {path}")


def read_landing(spark: SparkSession, path: str, schema: T.StructType = LANDING) -> DataFrame:
    """All documents below ``path``. Blank lines are skipped, a broken line fails the job.

    Keys the schema does not name are ignored, absent ones are null. ``OPEN_LANDING`` keeps every key
    of a block.
    """
    require_landing(spark, path)
    return _options(spark.read, schema, "FAILFAST").json(path)


def landing_stream(
    spark: SparkSession, path: str, max_files_per_batch: int | None = None,
    schema: T.StructType = LANDING,
) -> DataFrame:
    """The same documents as a stream of files, as strict about broken lines.

    Files are taken whatever their modification time, copies and backfills too. For that the
    stream remembers every landed file; moving loaded files away bounds that list.
    """
    reader = _options(spark.readStream, schema, "FAILFAST").option("maxFileAge", ANY_AGE)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.json(path)


class MalformedLanding(ValueError):
    """A landing file holds a line that is no document."""


def malformed_lines(
    spark: SparkSession, path: str, schema: T.StructType = LANDING, files: str = LINE_FILES
) -> DataFrame:
    """File, number from 1 and text of each line that does not parse; blank lines count as lines.

    A file is read in splits by many tasks. Each counts its split's lines and keeps the broken ones
    with their place in it, in one aggregate, whose groups never meet outside a task. A running sum
    over the splits of a file, a row each, then says how many lines lie before each.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    broken = F.from_json("value", with_corrupt, options)[_CORRUPT].isNotNull()
    lines = (
        spark.read.option("pathGlobFilter", files)
        .option("recursiveFileLookup", True)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("at"),
            F.when(broken, F.col("value")).alias("broken"),
        )
    )
    splits = lines.groupBy("file_path", "start").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("at").alias("first"),
        F.expr("collect_list(if(broken is null, null, struct(at, broken)))").alias("found"),
    )
    before = (
        "sum(lines) over (partition by file_path order by start"
        " rows between unbounded preceding and 1 preceding)"
    )
    return (
        splits.selectExpr("file_path", "first", "found", f"coalesce({before}, 0) as before")
        .selectExpr("file_path", "first", "before", "inline(found)")
        .selectExpr("file_path", "before + at - first + 1 as line", f"broken as {_CORRUPT}")
    )


def explain_malformed(spark: SparkSession, path: str, error: Exception) -> Exception:
    """What to raise where reading landing files failed: the first broken line if there is one."""
    found = malformed_lines(spark, path).orderBy("file_path", "line").first()
    if found is None:
        return error
    return MalformedLanding(f"{found['file_path']} line {found['line']}: {found[_CORRUPT][:200]}")


def write_landing(records: DataFrame, folder: str, start, end) -> str:
    """One lines folder per date window below ``folder``; the same window is overwritten."""
    path = f"{folder.rstrip('/')}/window_{start}_{end}"
    records.write.mode("overwrite").json(path)
    return path
