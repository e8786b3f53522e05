"""The batch run: landing files to checked presentation tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.functions.dates import DateRange, DateSet, resolve_range
from rainfold.operators import snapshots
from rainfold.operators.checks import failures_by_date, freshness, report_of, run_checks
from rainfold.operators.derived import follow
from rainfold.operators.open_series import explode_open, open_variables as variables_of
from rainfold.operators.rollup import roll_up_to_days
from rainfold.operators.series import explode_series, split_unparsable
from rainfold.operators.snapshots import Snapshot, read_snapshot, read_table
from rainfold.operators.tables import (
    LoadReport,
    holds_keys_once,
    load,
    read_bronze,
    register,
    spread_by_date,
    write_partitioned,
    write_table,
)
from rainfold.plans.additions import Tables, days_to_add, note_built, written_since
from rainfold.plans.declared_checks import declared_checks
from rainfold.plans.enriched import (
    daily_enriched,
    hourly_enriched,
    pair_daily,
    rollup_of_pairs,
)
from rainfold.plans.facts import (
    dim_locations,
    fct_daily,
    fct_daily_api,
    fct_daily_hourly,
    fct_daily_quality,
)
from rainfold.plans.staging import stg_daily, stg_hourly
from rainfold.schemas import DAILY, HOURLY, LANDING, OPEN_LANDING, Readings
from rainfold.session import concurrently, hadoop_path, materialize, prepare, remove
from rainfold.sources.landing import explain_malformed, read_landing
from rainfold.sources.locations import read_locations

KINDS = (HOURLY, DAILY)
# Table name to its layer and partition column; staging models stay views.
TABLES = {
    "hourly_enriched": ("silver", "p_date"),
    "daily_enriched": ("silver", "daily_p_date"),
    "dim_locations": ("gold", None),
    "fct_daily_api": ("gold", "dates"),
    "fct_daily_hourly": ("gold", "dates"),
    "fct_daily": ("gold", "dates"),
    "fct_daily_quality": ("gold", "dates"),
}


class StaleSource(RuntimeError):
    """A source is older than the error limit, so no model is built."""


@dataclass(frozen=True)
class Warehouse:
    """Folders of the layers below one root on shared storage.

    ``aliases`` renames output tables, for readers that expect other names.
    """

    spark: SparkSession
    root: str
    aliases: dict[str, str] = field(default_factory=dict)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{self.aliases.get(name, name)}"

    def files(self, kind) -> str:
        return self.path("files", kind.block)

    def bronze(self, kind) -> str:
        return self.path("bronze", kind.block)


def add_pending(warehouse: Warehouse, dates: DateSet) -> None:
    """Note days whose models have to be rebuilt, below the warehouse's root."""
    days = warehouse.spark.createDataFrame([(day,) for day in sorted(dates.days)], "day date")
    days.coalesce(1).write.parquet(f"{warehouse.path('pending', 'dates')}/{uuid.uuid4().hex}")


def _pending_notes(warehouse: Warehouse) -> list[str]:
    """The folders of the notes that wait, one for each call of ``add_pending``."""
    at, files = hadoop_path(warehouse.spark, warehouse.path("pending", "dates"))
    if not files.exists(at):
        return []
    return sorted(status.getPath().toString() for status in files.listStatus(at))


def _days_of(warehouse: Warehouse, notes: list[str]) -> frozenset[date]:
    if not notes:
        return frozenset()
    rows = warehouse.spark.read.schema("day date").parquet(*notes).distinct().collect()
    return frozenset(row["day"] for row in rows)


def pending_dates(warehouse: Warehouse) -> DateSet | None:
    days = _days_of(warehouse, _pending_notes(warehouse))
    return DateSet(days) if days else None


def _clear_pending(
    warehouse: Warehouse, notes: list[str], done: DateRange | DateSet | None
) -> None:
    """Forget notes whose days have been rebuilt (None stands for all days).

    Only the notes that were there when the rebuild began are looked at, and what they hold beyond
    ``done`` is noted again before they go: neither a day that arrives meanwhile nor a crash here
    loses one.
    """
    left = _days_of(warehouse, notes) - done.days if done else frozenset()
    if left:
        add_pending(warehouse, DateSet(left))
    remove(warehouse.spark, *notes)


def readings(records: DataFrame, kind: Readings, open_variables: bool) -> DataFrame:
    """Rows of one kind: of the fixed metrics, or of all variables in ``OPEN_LANDING`` records."""
    if not open_variables:
        return explode_series(records, kind)
    return explode_open(records, kind, variables_of(records, kind))


def flatten_landing(
    warehouse: Warehouse, landing: str, open_variables: bool = False
) -> dict[str, int]:
    """Landing documents to one partitioned dataset per kind of reading.

    The JSON is parsed once, before any dataset is replaced: a broken line leaves them as they
    are, and the error names its file and number. Rows whose time does not parse land in the partition without a date, which the load
    leaves out; their count per kind is returned. With ``open_variables`` every key of a block
    becomes a column, else those of the fixed metrics.
    """
    spark = prepare(warehouse.spark)
    held: list[str] = []

    def write(kind) -> int:
        rows = readings(records, kind, open_variables)
        write_partitioned(rows, warehouse.files(kind), kind.time_column)
        return bronze_files(warehouse, kind)[1].count()

    try:
        try:
            schema = OPEN_LANDING if open_variables else LANDING
            records = materialize(read_landing(spark, landing, schema), "landing", held)
        except (PySparkException, Py4JJavaError) as error:
            raise explain_malformed(spark, landing, error) from error
        return concurrently(spark, {kind.block: partial(write, kind) for kind in KINDS})
    finally:
        remove(spark, *held)


def bronze_files(warehouse: Warehouse, kind) -> tuple[DataFrame, DataFrame]:
    """Usable rows of the flattened dataset, and its quarantined rows."""
    return split_unparsable(read_bronze(warehouse.spark, warehouse.files(kind), kind))


def load_bronze(
    warehouse: Warehouse, mode: str = "upsert", open_variables: bool = False
) -> dict[str, LoadReport]:
    """Load the flattened datasets; with ``open_variables`` tables grow by the columns they lack."""

    def one(kind) -> LoadReport:
        usable, _ = bronze_files(warehouse, kind)
        return load(usable, warehouse.bronze(kind), kind, mode, grow=open_variables)

    return concurrently(
        prepare(warehouse.spark), {kind.block: partial(one, kind) for kind in KINDS}
    )


def check_sources(warehouse: Warehouse, now: datetime) -> DataFrame:
    spark = prepare(warehouse.spark)
    return freshness(
        {k.block: read_bronze(spark, warehouse.bronze(k), k) for k in KINDS}, now
    )


def model_tables(
    hourly: DataFrame,
    daily: DataFrame,
    locations: DataFrame,
    save,
    dates: DateRange | DateSet | None = None,
    held: list[str] | None = None,
    loaded: tuple[Readings, ...] = (),
) -> dict[str, DataFrame]:
    """All models by name. ``save(name, df)`` materializes a table and returns what to read.

    The hourly table is saved before the rollup reads it. Rollup and feed are paired once, and
    every daily table is a projection of the pairs, which are stored by day: that is the one shuffle
    by date for all of them. ``loaded`` names the kinds whose rows come from a table that loads made.
    """
    staged_hourly = stg_hourly(hourly, dates, HOURLY in loaded)
    staged_daily = stg_daily(daily, dates, DAILY in loaded)
    enriched = save("hourly_enriched", hourly_enriched(staged_hourly))
    if dates is not None:
        enriched = enriched.where(dates.covers(F.col("p_date")))
    rollup = roll_up_to_days(enriched)
    pairs = spread_by_date(pair_daily(staged_daily, rollup, marked=True), "day")
    pairs = materialize(pairs, "pairs", held, by="day")
    fed = pairs.where("in_feed")
    tables = {
        "daily_enriched": daily_enriched(pairs),
        "dim_locations": dim_locations(locations),
        "fct_daily_api": fct_daily_api(fed),
        "fct_daily_hourly": fct_daily_hourly(rollup_of_pairs(pairs)),
        "fct_daily": fct_daily(pairs),
        "fct_daily_quality": fct_daily_quality(pairs),
    }
    saved = concurrently(
        enriched.sparkSession, {name: partial(save, name, df) for name, df in tables.items()}
    )
    days = saved["daily_enriched"]
    if dates is not None:
        days = days.where(dates.covers(F.col("daily_p_date")))
    return saved | {
        "hourly_enriched": enriched,
        # The staged readings are the stored tables without what these add.
        "stg_hourly": enriched.select(*staged_hourly.columns),
        "stg_daily": days.withColumnsRenamed(
            {"daily_ingested_at": "ingested_at", "daily_p_date": "p_date"}
        ).select(*staged_daily.columns),
    }


def build_models(
    warehouse: Warehouse,
    locations_csv: str,
    dates: DateRange | DateSet | None = None,
    registered: bool = False,
    held: list[str] | None = None,
    on_saved: Callable[[str], None] | None = None,
) -> dict[str, DataFrame]:
    """Build silver and gold tables from bronze, fully or only for ``dates``.

    With ``registered`` the tables are also entered in the session catalog, one database per
    layer, and the staging models become temporary views. Days that waited when the rebuild began are
    cleared. Paths of intermediate tables are added to ``held``.
    ``on_saved`` is told the name of each table that readers can see from now on.

    Days of ``dates`` to which loads have only brought locations that they lacked are added to, from
    these loads alone; a catalog table, which has a folder a day, is not.
    """
    spark = prepare(warehouse.spark)
    notes = _pending_notes(warehouse)

    loaded = tuple(k for k in KINDS if holds_keys_once(spark, warehouse.bronze(k), k))
    sources = {k: snapshots.current(spark, warehouse.bronze(k)) for k in loaded}
    tables = _tables(warehouse, sources)
    read, replaced, added_to = dict(sources), dates, DateSet(frozenset())
    if dates is not None and loaded == KINDS and not registered:
        cells = warehouse.path("gold", "fct_daily")
        added_to, left = days_to_add(spark, tables, dates.days, cells)
        read = {k: left[warehouse.bronze(k)] for k in loaded}
        replaced = DateSet(dates.days - added_to.days)

    def save(name: str, df: DataFrame) -> DataFrame:
        layer, partition = TABLES[name]
        path = warehouse.path(layer, name)
        # Loaded readings and pairs are stored by date; readings of other making are shuffled.
        stored = name != "hourly_enriched" or HOURLY in loaded
        table = write_table(df, path, partition, replaced if partition else None, stored)
        if registered:
            days = dates.days if dates else None
            register(spark, layer, warehouse.aliases.get(name, name), path, partition, days)
        if on_saved:
            on_saved(name)
        if name == "hourly_enriched" and added_to.days:
            # The days that are added to are rolled up from what is added.
            return written_since(spark, path, tables.models[path])
        return table

    hourly, daily = (
        read_snapshot(spark, warehouse.bronze(kind), read[kind]) if kind in loaded
        else read_bronze(spark, warehouse.bronze(kind), kind)
        for kind in KINDS
    )
    models = model_tables(
        hourly, daily, read_locations(spark, locations_csv), save, dates, held, loaded
    )
    if added_to.days:
        whole = read_table(spark, warehouse.path("silver", "hourly_enriched"))
        whole = whole.where(dates.covers(F.col("p_date")))
        models["stg_hourly"] = whole.select(*models["stg_hourly"].columns)
        models["hourly_enriched"] = whole
    if registered:
        for name, staged in (
            ("stg_hourly", stg_hourly(hourly, loaded=HOURLY in loaded)),
            ("stg_daily", stg_daily(daily, loaded=DAILY in loaded)),
        ):
            staged.createOrReplaceTempView(warehouse.aliases.get(name, name))
    if loaded == KINDS:
        note_built(spark, _tables(warehouse, sources), dates.days if dates else None)
    _clear_pending(warehouse, notes, dates)
    return models


def _tables(warehouse: Warehouse, sources: dict[Readings, Snapshot]) -> Tables:
    """The bronze tables as the build reads them, and the dated models as they are now."""
    spark = warehouse.spark
    models = [warehouse.path(layer, name) for name, (layer, dated) in TABLES.items() if dated]
    return Tables(
        warehouse.path("built", "days"),
        {warehouse.bronze(kind): snapshot for kind, snapshot in sources.items()},
        {path: snapshots.current(spark, path) for path in models},
    )


# Stored table: the declared tables that its rows are checked as, and the columns these add to it.
_CHECKED_AS = {
    "hourly_enriched": (("hourly_enriched", "stg_hourly"), {}),
    "daily_enriched": (
        ("daily_enriched", "stg_daily"),
        {"ingested_at": "daily_ingested_at", "p_date": "daily_p_date"},
    ),
}


def check_models(warehouse: Warehouse) -> tuple[DataFrame, dict[str, set[date | None]]]:
    """The check report of the stored tables, and the days of each that were looked at for it.

    Failures are stored by check and date; only dates that changed since the last call are read. The
    staged readings are checked on the tables that hold them. A table without dates is checked whole.
    Tables are checked side by side.
    """
    spark = prepare(warehouse.spark)
    checks = declared_checks()
    own = {
        name: [check for check in checks if check.table in _CHECKED_AS.get(name, ((name,),))[0]]
        for name in TABLES
    }

    def state(name: str) -> str:
        return warehouse.path("checks", f"failures_{name}")

    def followed(name: str) -> set[date | None]:
        layer, partition = TABLES[name]
        columns = _CHECKED_AS.get(name, ((), {}))[1]

        def failures(rows: DataFrame) -> DataFrame:
            added = {new: F.col(old) for new, old in columns.items()}
            return failures_by_date(rows.withColumns(added), partition, own[name])

        return follow(spark, warehouse.path(layer, name), state(name), partition, failures)

    dated = [name for name, (_, partition) in TABLES.items() if partition]
    looked_at = concurrently(spark, {name: partial(followed, name) for name in dated})
    states = [
        read_table(spark, state(name)) if name in looked_at
        else run_checks({name: read_table(spark, warehouse.path(layer, name))}, own[name])
        for name, (layer, _) in TABLES.items()
    ]
    return report_of(spark, states, checks), looked_at


def run(
    warehouse: Warehouse,
    landing: str,
    locations_csv: str,
    now: datetime,
    mode: str = "upsert",
    dates: DateRange | DateSet | None = None,
    lookback_days: int | None = None,
    registered: bool = False,
    open_variables: bool = False,
) -> DataFrame:
    """Flatten, load, test freshness, build, check; returns the stored check report.

    ``dates``, or ``lookback_days`` back from the archive's last day, limit what is rebuilt;
    without either all is.
    A stale source stops the run before any model is built. Failed checks do not: the tables
    are already written, and the report says what is wrong with them.
    """
    flatten_landing(warehouse, landing, open_variables)
    load_bronze(warehouse, mode, open_variables)
    stale = check_sources(warehouse, now).where(F.col("status") == "error").first()
    if stale is not None:
        raise StaleSource(f"source {stale['source']} was last loaded at {stale['max_loaded_at']}")
    if dates is None and lookback_days is not None:
        dates = resolve_range(now.date(), lookback_days)
    held: list[str] = []
    models = build_models(warehouse, locations_csv, dates, registered, held)
    report = write_table(run_checks(models, declared_checks()), warehouse.path("checks", "report"))
    remove(warehouse.spark, *held)
    return report
