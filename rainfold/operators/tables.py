"""Partitioned tables and the three load modes.

Tables are snapshots of Parquet folders (``snapshots``). A partition date is a function of the key, so
an upsert only rewrites the dates on which its batch has keys of stored rows, and adds to others.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace as changed
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainfold.functions.dates import DateRange, DateSet
from rainfold.operators import snapshots
from rainfold.operators.guards import KeyConflict, require_columns, require_unique
from rainfold.operators.latest import latest_by_key
from rainfold.operators.series import with_partition_date
from rainfold.operators.snapshots import Snapshot, read_snapshot, read_table
from rainfold.schemas import DAILY, HOURLY, Readings
from rainfold.session import hadoop_path, prepare, remove, scratch_path

PARTITION = "p_date"
MODES = ("replace", "append", "upsert")
# Fixed value: an upsert writes a date as one load again that has been added to this often.
MOST_LOADS = 8
_IN_BATCH = "_in_batch"


def spread_by_date(df: DataFrame, column: str = PARTITION) -> DataFrame:
    """Shuffle rows so that each date lands in few files, sorted by location within them.

    The rebalance hint lets adaptive execution split a date that holds much of the data and
    merge small ones; a plain repartition by date would put a hot date into one task. The
    writer sorts by date anyway; with the location added, file statistics let a reader skip
    most of a date when it asks for one location.
    """
    return _sorted_by_date(df.hint("rebalance", column), column)


def _sorted_by_date(df: DataFrame, column: str) -> DataFrame:
    order = [c for c in (column, "location_id") if c in df.columns]
    return df.sortWithinPartitions(*order)


def write_partitioned(rows: DataFrame, path: str, time_column: str) -> None:
    """Replace the dataset at ``path``, one folder per date of ``time_column``.

    An empty frame leaves an empty dataset, which readers open with their schema.
    """
    kinds = {kind.time_column: kind for kind in (HOURLY, DAILY)}
    if time_column not in kinds:
        raise ValueError(f"time column must be one of {sorted(kinds)}, not {time_column!r}")
    dated = with_partition_date(rows, kinds[time_column])
    snapshots.replace_table(spread_by_date(dated), path, PARTITION, keys=[])


def write_table(
    df: DataFrame,
    path: str,
    partition: str | None = None,
    dates: DateRange | DateSet | None = None,
    stored_by_date: bool = False,
) -> DataFrame:
    """Rebuild a table, or with ``dates`` only its partitions of those days, and read it back.

    A day of ``dates`` that has no rows any more loses its partition; rows of ``df`` on other days are
    added to what these have. Readers see the whole rebuild or the table as it was. With ``stored_by_date`` the rows
    come from files of one day each without a shuffle: every task has few days as they are.
    """
    spread = df
    if partition:
        spread = (_sorted_by_date if stored_by_date else spread_by_date)(df, partition)
    after = snapshots.replace_table(spread, path, partition, dates.days if dates else None)
    return read_snapshot(df.sparkSession, path, after).select(*df.columns)


def read_bronze(spark: SparkSession, path: str, kind: Readings) -> DataFrame:
    """Bronze dataset with its schema; the path must exist.

    A folder of plain Parquet files, partitioned by date, can be read as well.
    """
    if snapshots.current(spark, path) is not None:
        return read_table(spark, path)
    return spark.read.schema(kind.schema).parquet(path)


def holds_keys_once(spark: SparkSession, path: str, kind: Readings) -> bool:
    """Whether loads made the table, which keep its key unique; see ``latest_of_loaded``."""
    found = snapshots.current(spark, path)
    return found is not None and found.keys == list(kind.keys)


def ensure_table(spark: SparkSession, path: str, kind: Readings) -> Snapshot:
    """Create an empty table unless there is one; what the table holds."""
    found = snapshots.current(spark, path)
    if found is not None:
        return found
    at, files = hadoop_path(spark, path)
    if files.exists(at) and any(
        status.getPath().getName().startswith(f"{PARTITION}=") for status in files.listStatus(at)
    ):
        raise ValueError(f"{path} holds files that no load of this library wrote")
    snapshots.publish(spark, path, Snapshot(kind.schema, keys=list(kind.keys)))
    return snapshots.current(spark, path)


def register(
    spark: SparkSession, database: str, name: str, path: str, partition: str | None = None,
    days: Iterable[date] | None = None,
) -> None:
    """Make a table queryable as ``database.name`` as it is now, creating the database if absent.

    With ``days`` only their partitions are entered anew; else all are. Rows without a partition value
    are not seen by name.
    """
    snapshot = snapshots.current(spark, path)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    fields = [f for f in snapshot.schema if f.name != partition]
    fields += [snapshot.schema[partition]] if partition else []
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    base = path.rstrip("/")
    if not partition:
        place = f"{base}/{snapshot.folders[0]}" if snapshot.folders else f"{base}/_empty"
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.sql(
            f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet LOCATION '{place}'"
        )
        return
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet"
        f" PARTITIONED BY (`{partition}`) LOCATION '{base}'"
    )
    shown = spark.sql(f"SHOW PARTITIONS `{database}`.`{name}`").collect()
    entered = {row[0] for row in shown}
    for part in sorted(entered - set(snapshot.live)):
        spark.sql(f"ALTER TABLE `{database}`.`{name}` DROP PARTITION ({_literal(part)})")
    wanted = None if days is None else {snapshots.part_of(partition, day) for day in days}
    for part, loads in snapshot.live.items():
        if snapshots.NO_VALUE in part or wanted is not None and part not in wanted:
            continue
        place = f"{base}/{part}/{snapshots.LOAD}={loads[0]}"
        spec = f"PARTITION ({_literal(part)})"
        change = f"{spec} SET" if part in entered else f"ADD {spec}"
        spark.sql(f"ALTER TABLE `{database}`.`{name}` {change} LOCATION '{place}'")
    spark.catalog.refreshTable(f"`{database}`.`{name}`")


def _literal(part: str) -> str:
    column, _, day = part.partition("=")
    return f"`{column}` = DATE'{day}'"


@dataclass(frozen=True)
class LoadReport:
    mode: str
    rows_read: int
    rows_loaded: int
    # The days whose rows changed; models need a rebuild for these only.
    dates: DateSet | None = None

    @property
    def duplicates(self) -> int:
        return self.rows_read - self.rows_loaded

    @property
    def skipped(self) -> bool:
        return self.rows_loaded == 0


@dataclass(frozen=True)
class Change:
    """A load that is written but not yet seen by readers.

    ``staged`` is the deduplicated batch, which may be the load itself; it and ``held`` last until
    ``finish``.
    """

    spark: SparkSession
    path: str
    kind: Readings
    report: LoadReport
    staged: DataFrame | None = None
    before: Snapshot | None = None
    after: Snapshot | None = None
    held: tuple[str, ...] = ()

    def publish(self) -> None:
        """Show the load to readers that open the table from now on."""
        if self.after is not None:
            snapshots.publish(self.spark, self.path, self.after)

    def finish(self) -> None:
        """Remove the staged batch."""
        remove(self.spark, *self.held)


def load(
    batch: DataFrame, path: str, kind: Readings, mode: str = "upsert", grow: bool = False
) -> LoadReport:
    """Load a batch into the table at ``path``, newest row per key within the batch.

    ``replace`` rewrites the table. ``append`` adds rows and fails on a key the table has.
    ``upsert`` inserts new keys and overwrites the batch's columns of existing ones, whatever
    their ingestion time; columns a narrower batch lacks keep their values. With ``grow`` columns
    that the table lacks are added to it, else they are an error. An empty batch changes nothing.
    Keys with a null part never match.
    """
    change = prepare_load(batch, path, kind, mode, grow)
    try:
        change.publish()
    finally:
        change.finish()
    return change.report


def prepare_load(
    batch: DataFrame, path: str, kind: Readings, mode: str = "upsert", grow: bool = False
) -> Change:
    """Write all of a load but what makes it seen; see ``load``."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    require_columns(batch, kind.keys, "batch")
    spark = prepare(batch.sparkSession)
    known = snapshots.current(spark, path)
    schema = _grown(known.schema if known else kind.schema, batch.schema, grow)
    by_date = _rows_by_date(batch, kind)
    read = sum(by_date.values())
    if not read:
        return Change(spark, path, kind, LoadReport(mode, 0, 0))
    before = snapshots.swept(spark, path, ensure_table(spark, path, kind))
    if mode != "replace":
        _require_key(spark, path, before, kind)
        if before.parts(PARTITION, by_date):
            stage = scratch_path(spark, "stage")
            try:
                return _prepare_staged(
                    spark, batch, path, kind, mode, schema, stage, before, by_date
                )
            except BaseException:
                remove(spark, stage)
                raise
    # No stored row stays on the batch's days, so its rows are written once, as what they will be.
    name, written = snapshots.write_load(
        spread_by_date(_full_width(_newest(batch, kind), schema)), path, PARTITION
    )
    replaced = list(before.live) if mode == "replace" else []
    after = snapshots.with_load(before, name, written, replaced, schema=schema, keys=list(kind.keys))
    loaded = read_snapshot(spark, path, changed(after, live=dict.fromkeys(written, [name])))
    # Days that only the old table has lose their rows, so their models change too.
    dates = DateSet(frozenset([*by_date, *(_days(before) if mode == "replace" else ())]))
    report = LoadReport(mode, read, loaded.count(), dates)
    return Change(spark, path, kind, report, loaded, before, after)


def _rows_by_date(batch: DataFrame, kind: Readings) -> dict[date, int]:
    """Rows of each day of a batch, repeats of a key included. They are counted in a job of its own:
    what a task observes is counted again when the task is."""
    times = with_partition_date(batch.select(*kind.keys), kind)
    counted = times.groupBy(PARTITION).agg(F.count("*").alias("n")).collect()
    by_date = {r[PARTITION]: r["n"] for r in counted}
    if None in by_date:
        timeless = times.where(F.col(PARTITION).isNull()).select(*kind.keys).distinct().count()
        raise ValueError(f"{timeless} rows have no {kind.time_column}; quarantine them first")
    return by_date


def _grown(schema: T.StructType, batch: T.StructType, grow: bool) -> T.StructType:
    """The table's columns and, before the partition, those that the batch adds."""
    types = {f.name: f.dataType for f in schema}
    added = [f for f in batch if f.name not in types]
    if added and not grow:
        raise ValueError(f"batch has columns the table lacks: {sorted(f.name for f in added)}")
    for f in batch:
        if isinstance(f.dataType, T.StringType) and isinstance(types.get(f.name), T.DoubleType):
            raise ValueError(f"column {f.name} of the table holds numbers, the batch brings text")
    *fields, last = schema
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType) for f in added], last])


def _prepare_staged(
    spark: SparkSession, batch: DataFrame, path: str, kind: Readings, mode: str,
    schema: T.StructType, stage: str, before: Snapshot, by_date: dict[date, int],
) -> Change:
    """A load of days that the table has rows of."""
    staged = _stage(batch, kind, stage)
    touched = before.parts(PARTITION, by_date)
    # The touched days' folders are all that is read before anything is joined.
    current = read_snapshot(spark, path, before, touched)
    if mode == "append":
        _refuse_known_keys(staged, current, path, kind)
        rewritten = []
    else:
        known = before.parts(PARTITION, _days_of_known_keys(staged, current, kind))
        rewritten = [p for p in touched if p in known or len(before.live[p]) >= MOST_LOADS]
    # Days on which no stored row changes get a folder more; no stored row of theirs is moved.
    content = staged
    if rewritten:
        content = _merged(staged, read_snapshot(spark, path, before, rewritten), kind, schema)
    name, written = snapshots.write_load(
        spread_by_date(_full_width(content, schema)), path, PARTITION
    )
    after = snapshots.with_load(
        before, name, written, rewritten, schema=schema, keys=list(kind.keys)
    )
    report = LoadReport(
        mode, sum(by_date.values()), staged.count(), DateSet(frozenset(by_date))
    )
    return Change(spark, path, kind, report, staged, before, after, (stage,))


def share_locations(rows: DataFrame, others: DataFrame) -> bool:
    """Whether a location of ``rows`` is in ``others`` too, or ``rows`` have none somewhere.

    The rows combine to locations before the one shuffle.
    """
    marked = rows.selectExpr("location_id", "1 as of_rows", "0 as of_others").unionAll(
        others.selectExpr("location_id", "0 as of_rows", "1 as of_others")
    )
    found = marked.groupBy("location_id").agg(
        F.max("of_rows").alias("of_rows"), F.max("of_others").alias("of_others")
    )
    return not found.where(
        "of_rows = 1 and (of_others = 1 or location_id is null)"
    ).isEmpty()


def _days_of_known_keys(staged: DataFrame, current: DataFrame, kind: Readings) -> list[date]:
    """The days on which the batch has a key that the table has, from the keys alone."""
    if not share_locations(staged, current):
        return []
    keys = list(kind.keys)
    known = current.select(*keys, PARTITION).join(staged.select(*keys), keys, "left_semi")
    return [row[PARTITION] for row in known.select(PARTITION).distinct().collect()]


def _days(snapshot: Snapshot) -> list[date]:
    texts = [part.partition("=")[2] for part in snapshot.live]
    return [date.fromisoformat(text) for text in texts if text != snapshots.NO_VALUE]


def _require_key(spark: SparkSession, path: str, before: Snapshot, kind: Readings) -> None:
    """Loads keep a table's key unique; only a table of other making is looked through, once."""
    if before.keys != list(kind.keys):
        require_unique(read_snapshot(spark, path, before), kind.keys, f"table {path}")


def _newest(batch: DataFrame, kind: Readings) -> DataFrame:
    keyed = latest_by_key(batch.drop(PARTITION), kind.keys, newest_first=["ingested_at"])
    return with_partition_date(keyed, kind)


def _stage(batch: DataFrame, kind: Readings, path: str) -> DataFrame:
    """The deduplicated batch as a table in the shared folder."""
    dated = _newest(batch, kind)
    dated.write.parquet(path)
    return batch.sparkSession.read.schema(dated.schema).parquet(path)


def _full_width(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(
        *[
            F.col(f"`{field.name}`").cast(field.dataType).alias(field.name)
            if field.name in rows.columns
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in schema
        ]
    )


def _refuse_known_keys(staged: DataFrame, current: DataFrame, path: str, kind: Readings) -> None:
    clash = staged.join(current, list(kind.keys), "left_semi").select(*kind.keys).first()
    if clash is not None:
        raise KeyConflict(f"table {path} already has key {clash.asDict()}")


def _merged(
    staged: DataFrame, current: DataFrame, kind: Readings, schema: T.StructType
) -> DataFrame:
    """New content of the partitions the batch touches."""
    keys = list(kind.keys)
    brought = [c for c in staged.columns if c not in (*keys, PARTITION)]
    current = _full_width(current, schema)
    if not brought:
        # Nothing but keys: existing rows stay as they are.
        added = staged.join(current, keys, "left_anti")
        return current.unionByName(_full_width(added, schema))
    if len(staged.columns) == len(schema):
        kept = current.join(staged, keys, "left_anti")
        return kept.unionByName(_full_width(staged, schema))
    both = current.alias("t").join(
        staged.withColumn(_IN_BATCH, F.lit(True)).alias("b"), keys, "full"
    )

    def value(name: str):
        if name in keys:
            return F.col(name)
        if name == PARTITION:
            return F.coalesce(f"t.{name}", f"b.{name}").alias(name)
        if name in brought:
            return F.when(F.col(_IN_BATCH), F.col(f"b.`{name}`")).otherwise(
                F.col(f"t.`{name}`")
            ).alias(name)
        return F.col(f"t.`{name}`")

    return both.select(*[value(name) for name in schema.fieldNames()])


def require_table_keys(spark: SparkSession, path: str, kind: Readings) -> None:
    """Fail if a table holds a key twice."""
    require_unique(read_bronze(spark, path, kind), kind.keys, f"table {path}")
