"""Tables that can be read while they are loaded.

A table is a folder of Parquet folders, one for each partition and load, and one small file that names
those that hold its rows now. A load writes new folders beside the old ones and then replaces that file
by a rename, so readers see either all of a load or nothing of it. Readers follow the file and change
nothing. A frame that was opened before a load keeps reading the folders it was opened on: folders that
a load replaced stay for ``KEEP_SECONDS`` and are removed by a later load.

The file's size is bounded by the calendar: an entry for each partition, and one for each folder that
waits for its removal. One load of a table at a time is presumed.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace as changed
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainfold.session import hadoop_path, remove

# The file that names a table's folders, the folder level of a load, the partition of
# rows without a value, and how long a replaced folder stays.
POINTER = "_current"
LOAD = "load"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
KEEP_SECONDS = 86_400


@dataclass(frozen=True)
class Snapshot:
    """What a table holds: its schema and, by partition folder, the loads that wrote its rows.

    The partition folder of a table without partitions is empty text. ``gone`` has the time when a
    folder was replaced, ``keys`` the key that the table is known to hold once only, and ``made_from``
    by partition folder the loads of the table that a derived one was computed from.
    """

    schema: T.StructType
    live: dict[str, list[str]] = field(default_factory=dict)
    gone: dict[str, float] = field(default_factory=dict)
    keys: list[str] = field(default_factory=list)
    made_from: dict[str, list[str]] = field(default_factory=dict)

    @property
    def folders(self) -> list[str]:
        return [_folder(part, load) for part, loads in self.live.items() for load in loads]

    def parts(self, partition: str, days: Iterable[date | None]) -> list[str]:
        """The live partition folders of some days."""
        wanted = {part_of(partition, day) for day in days}
        return [part for part in self.live if part in wanted]


def part_of(partition: str, day: date | None) -> str:
    return f"{partition}={NO_VALUE if day is None else day}"


def _folder(part: str, load: str) -> str:
    return f"{part}/{LOAD}={load}" if part else f"{LOAD}={load}"


def current(spark: SparkSession, path: str) -> Snapshot | None:
    """What the table holds now, None without a table."""
    at, files = hadoop_path(spark, f"{path.rstrip('/')}/{POINTER}")
    for attempt in range(4):
        try:
            if not files.exists(at):
                return None
            stream = files.open(at)
            try:
                text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            break
        except Py4JJavaError:
            # A local file and its checksum are two files, which a rename replaces one by one.
            if attempt == 3:
                raise
            time.sleep(0.05)
    known = json.loads(text)
    return Snapshot(T.StructType.fromJson(known.pop("schema")), **known)


def publish(spark: SparkSession, path: str, snapshot: Snapshot) -> None:
    """Make ``snapshot`` what readers see, in one step."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    new, files = hadoop_path(spark, f"{path.rstrip('/')}/{POINTER}.{uuid.uuid4().hex}")
    known = {
        "schema": snapshot.schema.jsonValue(), "live": snapshot.live, "gone": snapshot.gone,
        "keys": snapshot.keys, "made_from": snapshot.made_from,
    }
    stream = files.create(new, True)
    stream.write(bytearray(json.dumps(known).encode()))
    stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    target, _ = hadoop_path(spark, f"{path.rstrip('/')}/{POINTER}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), conf).rename(
        new, target, options
    )


def write_load(df: DataFrame, path: str, partition: str | None) -> tuple[str, list[str]]:
    """Write rows as a load of their own that nobody sees yet; its name and its partition folders.

    The folders are those on storage, whatever was expected to be in them.
    """
    spark = df.sparkSession
    load = uuid.uuid4().hex[:12]
    levels = [partition, LOAD] if partition else [LOAD]
    df.withColumn(LOAD, F.lit(load)).write.mode("append").partitionBy(*levels).parquet(path)
    at, files = hadoop_path(
        spark, f"{path.rstrip('/')}/{f'{partition}=*/' if partition else ''}{LOAD}={load}"
    )
    found = files.globStatus(at) or []
    if not partition:
        return load, [""] if len(found) else []
    return load, [status.getPath().getParent().getName() for status in found]


def with_load(
    before: Snapshot, load: str, written: Iterable[str], replaced: Iterable[str], **more
) -> Snapshot:
    """``before`` with the folders of a load in place of ``replaced`` partitions."""
    live = {part: list(loads) for part, loads in before.live.items()}
    gone, now = dict(before.gone), time.time()
    for part in replaced:
        for old in live.pop(part, []):
            gone[_folder(part, old)] = now
    for part in written:
        live[part] = live.get(part, []) + [load]
    return changed(before, live=live, gone=gone, **more)


def swept(spark: SparkSession, path: str, snapshot: Snapshot) -> Snapshot:
    """Remove the folders that were replaced long enough ago; the snapshot without them."""
    due = {f for f, since in snapshot.gone.items() if since < time.time() - KEEP_SECONDS}
    remove(spark, *[f"{path.rstrip('/')}/{folder}" for folder in sorted(due)])
    left = {f: since for f, since in snapshot.gone.items() if f not in due}
    return changed(snapshot, gone=left)


def replace_table(
    df: DataFrame, path: str, partition: str | None, days: Iterable[date | None] | None = None,
    **more,
) -> Snapshot:
    """Replace all rows, or with ``days`` those of the partitions of these days.

    A day of them that has no rows any more loses its partition.
    """
    spark = df.sparkSession
    before = current(spark, path)
    before = Snapshot(df.schema) if before is None else swept(spark, path, before)
    load, written = write_load(df, path, partition)
    old = list(before.live) if days is None else before.parts(partition, days)
    after = with_load(before, load, written, old, schema=df.schema, **more)
    publish(spark, path, after)
    return after


def read_snapshot(
    spark: SparkSession, path: str, snapshot: Snapshot, parts: Iterable[str] | None = None
) -> DataFrame:
    """The rows of a snapshot, or of some of its partition folders."""
    chosen = snapshot if parts is None else changed(
        snapshot, live={part: snapshot.live[part] for part in parts if part in snapshot.live}
    )
    names = snapshot.schema.fieldNames()
    if not chosen.folders:
        return spark.createDataFrame([], snapshot.schema)
    base = path.rstrip("/")
    return (
        spark.read.schema(snapshot.schema)
        .option("basePath", base)
        .parquet(*[f"{base}/{folder}" for folder in chosen.folders])
        .select(*names)
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows as of now; later loads do not change what the frame reads."""
    snapshot = current(spark, path)
    if snapshot is None:
        raise FileNotFoundError(f"no table at {path}")
    return read_snapshot(spark, path, snapshot)
