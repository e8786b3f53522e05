"""One query per operator and model, over the driver's tables through the bridge."""

from __future__ import annotations

import re
import uuid
from datetime import date, datetime
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.functions.bands import band_columns, flag_columns
from rainfold.functions.dates import DateSet, resolve_range
from rainfold.operators import checks as c
from rainfold.operators import guards, latest
from rainfold.operators.daily_state import load_with_state, stored_rollup
from rainfold.operators.latest import latest_by_key
from rainfold.operators.rollup import roll_up_to_days
from rainfold.operators.series import (
    explode_series,
    landing_records,
    pack_series,
    split_unparsable,
    zip_series,
)
from rainfold.operators.snapshots import read_table
from rainfold.operators.stack import stack_by_name
from rainfold.operators.statistics import column_figures, follow_figures, key_figures, newest
from rainfold.operators.tables import load, prepare_load, read_bronze, write_partitioned
from rainfold.plans import colocated, enriched, facts, pipeline, staging
from rainfold.plans.declared_checks import declared_checks
from rainfold.plans.pipeline import model_tables
from rainfold.schemas import DAILY, HOURLY, Readings
from rainfold.session import concurrently, hadoop_path, materialize, scratch_path
from rainfold.sources.landing import malformed_lines, read_landing, write_landing
from rainfold.sources import locations
from rainfold.streaming.landing_stream import load_new_landing
from rainfold.workload import bridge

NOW = datetime(2024, 2, 10, 12, 0, 0)
BUCKETS = 8
RANGE = resolve_range(date(2024, 1, 25), 7)


def _hourly(spark: SparkSession, sf_dir: str, dates=None) -> DataFrame:
    return staging.stg_hourly(bridge.bronze_hourly(spark, sf_dir), dates)


def _daily(spark: SparkSession, sf_dir: str, dates=None) -> DataFrame:
    return staging.stg_daily(bridge.bronze_daily(spark, sf_dir), dates)


def _pairs(spark: SparkSession, sf_dir: str, how: str = "full", dates=None) -> DataFrame:
    rollup = roll_up_to_days(_hourly(spark, sf_dir, dates))
    return enriched.pair_daily(_daily(spark, sf_dir, dates), rollup, how)


def typed_hourly(spark, sf_dir):
    return staging.typed(bridge.bronze_hourly(spark, sf_dir), HOURLY)


def typed_daily(spark, sf_dir):
    return staging.typed(bridge.bronze_daily(spark, sf_dir), DAILY)


def dedup_hourly_latest(spark, sf_dir):
    return _hourly(spark, sf_dir)


def dedup_daily_latest(spark, sf_dir):
    return _daily(spark, sf_dir)


def dedup_keep_last(spark, sf_dir):
    """The newest event per user and type."""
    events = bridge.table(spark, sf_dir, "events").withColumnRenamed("ts", "ingested_at")
    return latest_by_key(events, ["user_id", "event_type"])


def hot_key_dedup(spark, sf_dir):
    """The newest event per type: few keys, each with a large share of all rows."""
    events = bridge.table(spark, sf_dir, "events").withColumnRenamed("ts", "ingested_at")
    return latest_by_key(events, ["event_type"])


def duplicate_count(spark, sf_dir):
    return latest.duplicate_count(bridge.bronze_hourly(spark, sf_dir), HOURLY.keys)


def hourly_bands(spark, sf_dir):
    return _hourly(spark, sf_dir).select("location_id", "observed_at", *band_columns())


def hourly_flags(spark, sf_dir):
    return _hourly(spark, sf_dir).select("location_id", "observed_at", *flag_columns())


def hourly_enriched(spark, sf_dir):
    return enriched.hourly_enriched(_hourly(spark, sf_dir))


def daily_rollup(spark, sf_dir):
    return roll_up_to_days(_hourly(spark, sf_dir))


def daily_enriched(spark, sf_dir):
    return enriched.daily_enriched(_pairs(spark, sf_dir, "left"))


def daily_enriched_off_midnight(spark, sf_dir):
    """Some feed rows bear six o'clock: they have no hourly counterpart."""
    late = F.expr("if(day(dates) % 7 = 3, dates + interval 6 hours, dates)")
    feed = _daily(spark, sf_dir).withColumn("dates", late)
    pairs = enriched.pair_daily(feed, roll_up_to_days(_hourly(spark, sf_dir)), "left")
    return enriched.daily_enriched(pairs)


def fct_daily_api(spark, sf_dir):
    return facts.fct_daily_api(_daily(spark, sf_dir))


def fct_daily_hourly(spark, sf_dir):
    return facts.fct_daily_hourly(roll_up_to_days(_hourly(spark, sf_dir)))


def fct_daily(spark, sf_dir):
    return facts.fct_daily(_pairs(spark, sf_dir))


def fct_daily_bucketed(spark, sf_dir):
    """The canonical fact from bucketed tables, without an exchange from bronze to fact."""
    names = {}
    for kind, rows in ((HOURLY, bridge.bronze_hourly), (DAILY, bridge.bronze_daily)):
        names[kind] = f"rainfold_{kind.block}_{uuid.uuid4().hex}"
        colocated.save_bucketed(rows(spark, sf_dir), names[kind], BUCKETS)
    return facts.fct_daily(colocated.pair_daily(spark, names[HOURLY], names[DAILY]))


def fct_daily_ranged(spark, sf_dir):
    """The canonical fact of a date range, cut on both inputs before dedup and join."""
    return facts.fct_daily(_pairs(spark, sf_dir, dates=RANGE))


def _quality(pairs: DataFrame) -> DataFrame:
    score = F.col("completeness_score").cast("double")
    return facts.fct_daily_quality(pairs).withColumn("completeness_score", score)


def fct_daily_quality(spark, sf_dir):
    return _quality(_pairs(spark, sf_dir))


def quality_status_counts(spark, sf_dir):
    return (
        _quality(_pairs(spark, sf_dir))
        .groupBy("reconciliation_status")
        .agg(F.count(F.lit(1)).alias("days"), F.avg("completeness_score").alias("mean_score"))
        .withColumn("mean_score", F.round("mean_score", 6))
    )


def dim_locations(spark, sf_dir):
    return facts.dim_locations(bridge.locations(spark, sf_dir))


def active_locations(spark, sf_dir):
    return locations.active_locations(bridge.locations(spark, sf_dir))


def series_explode(spark, sf_dir):
    """Each vector as a series of values over positions, beside a series that is null."""
    vectors = bridge.table(spark, sf_dir, "embeddings")
    size = F.size("embedding")
    positions = F.when(size > 0, F.sequence(F.lit(1), size))
    absent = F.lit(None).cast("array<double>")
    zipped = zip_series(
        positions,
        {"value": F.col("embedding").cast("array<double>"), "absent": absent},
        time_field="position",
    )
    return vectors.select("vec_id", "label", F.inline(zipped))


def json_props(spark, sf_dir):
    events = bridge.table(spark, sf_dir, "events")
    parsed = events.select("event_id", F.from_json("props", "k bigint").alias("parsed"))
    return parsed.select("event_id", "parsed.k", F.to_json("parsed").alias("json"))


def _records(spark: SparkSession, sf_dir: str, places: str = "true") -> DataFrame:
    """Landing documents of some locations, which are chosen before anything is packed or joined."""
    return landing_records(
        _hourly(spark, sf_dir).where(places),
        _daily(spark, sf_dir).withColumnRenamed("dates", "date").where(places),
        bridge.locations(spark, sf_dir),
        unique=True,
    )


def _landed(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch_path(spark, "landing")
    return write_landing(_records(spark, sf_dir), folder, "2024-01-01", "2024-12-31")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landing(spark, _landed(spark, sf_dir))


def landing_roundtrip(spark, sf_dir):
    """Readings packed to nested JSON lines, written, read back and exploded."""
    return explode_series(_documents(spark, sf_dir), HOURLY)


def landing_roundtrip_daily(spark, sf_dir):
    return explode_series(_documents(spark, sf_dir), DAILY)


def landing_incremental(spark, sf_dir):
    """Documents in two deliveries, of which the later one's files bear an older time."""
    folder = scratch_path(spark, "landing")
    warehouse = pipeline.Warehouse(spark, scratch_path(spark, "warehouse"))
    first, second = (
        _records(spark, sf_dir, f"pmod(hash(location_id), 2) = {half}") for half in (0, 1)
    )
    write_landing(first, folder, "2024-01-01", "2024-06-30")
    load_new_landing(warehouse, folder)
    late = write_landing(second, folder, "2024-07-01", "2024-12-31")
    at, files = hadoop_path(spark, late)
    for file in files.listStatus(at):
        # Four hundred days back, in milliseconds.
        moment = file.getModificationTime() - 400 * 86_400_000
        files.setTimes(file.getPath(), moment, moment)
    load_new_landing(warehouse, folder)
    return read_bronze(spark, warehouse.bronze(HOURLY), HOURLY)


def quarantined_rows(spark, sf_dir):
    """Readings whose time text is broken keep their values and lose time and date."""
    broken = F.transform(
        "payload.hourly.time", lambda t: F.when(t.endswith("T05:00"), F.lit("noon")).otherwise(t)
    )
    hourly = F.col("payload").withField("hourly.time", broken)
    rows = explode_series(_documents(spark, sf_dir).withColumn("payload", hourly), HOURLY)
    return split_unparsable(rows)[1]


def malformed_line_numbers(spark, sf_dir):
    """Events' properties as lines of one file for each type, some cut short and some blank."""
    path = scratch_path(spark, "lines")
    cut = (
        "case when event_id % 37 = 0 then substring(props, 1, length(props) - 1)"
        " when event_id % 41 = 5 then ' ' else props end as value"
    )
    (
        bridge.table(spark, sf_dir, "events")
        .selectExpr("event_type", "event_id", cut)
        .repartition("event_type")
        .sortWithinPartitions("event_type", "event_id")
        .select("event_type", "value")
        .write.partitionBy("event_type")
        .text(path)
    )
    found = malformed_lines(spark, path, files="*.txt")
    return found.selectExpr(
        "regexp_extract(file_path, 'event_type=([^/]+)', 1) as file", "line", "malformed"
    )


def open_variables(spark, sf_dir):
    """Two deliveries whose blocks hold other variables each, upserted into one table that grows."""
    folder = scratch_path(spark, "landing")
    warehouse = pipeline.Warehouse(spark, scratch_path(spark, "warehouse"))
    hourly = _hourly(spark, sf_dir).withColumns(
        {"gusts": F.col("wind_speed_10m") * 2, "sky": F.expr("if(rain > 0, 'wet', 'dry')")}
    )
    deliveries = {
        "day(p_date) <= 18": ("temperature_2m", "relative_humidity_2m", "rain", "gusts"),
        "day(p_date) >= 12": ("temperature_2m", "wind_speed_10m", "sky"),
    }
    for days, variables in deliveries.items():
        kind = Readings("hourly", "observed_at", variables)
        blocks = pack_series(hourly.where(days), kind)
        records = blocks.select(
            "location_id",
            F.lit("2024-06-01T00:00:00+00:00").alias("ingested_at"),
            F.struct("hourly").alias("payload"),
        )
        write_landing(records, folder, len(variables), "2024-12-31")
        load_new_landing(warehouse, folder, open_variables=True)
    return read_bronze(spark, warehouse.bronze(HOURLY), HOURLY)


def locations_csv(spark, sf_dir):
    """The location list as a CSV whose columns are in another order."""
    path = scratch_path(spark, "locations")
    _write_locations(bridge.locations(spark, sf_dir), path)
    return locations.read_locations(spark, path)


def _write_locations(rows: DataFrame, path: str) -> str:
    shuffled = rows.select(*sorted(rows.columns, reverse=True))
    shuffled.write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


def _whole_run(spark: SparkSession, sf_dir: str) -> pipeline.Warehouse:
    warehouse = pipeline.Warehouse(spark, scratch_path(spark, "warehouse"))
    seed = _write_locations(bridge.locations(spark, sf_dir), scratch_path(spark, "locations"))
    pipeline.run(warehouse, _landed(spark, sf_dir), seed, NOW)
    return warehouse


def pipeline_fct_daily(spark, sf_dir):
    """Landing files through all stages of the run; the canonical fact as stored."""
    warehouse = _whole_run(spark, sf_dir)
    return read_table(spark, warehouse.path("gold", "fct_daily"))


def pipeline_quality(spark, sf_dir):
    """The quality fact of the run."""
    warehouse = _whole_run(spark, sf_dir)
    table = read_table(spark, warehouse.path("gold", "fct_daily_quality"))
    return table.withColumn("completeness_score", F.col("completeness_score").cast("double"))


def tables_by_name(spark, sf_dir):
    """The run's tables in the catalog, one of them under another name, and a staging view, in SQL."""
    warehouse = pipeline.Warehouse(
        spark, scratch_path(spark, "warehouse"), {"fct_daily": "daily_canonical"}
    )
    seed = _write_locations(bridge.locations(spark, sf_dir), scratch_path(spark, "locations"))
    for kind, rows in ((HOURLY, bridge.bronze_hourly), (DAILY, bridge.bronze_daily)):
        load(rows(spark, sf_dir), warehouse.bronze(kind), kind)
    pipeline.build_models(warehouse, seed, registered=True)
    return spark.sql(
        "select f.location_id, f.dates, f.temperature_2m_max, l.location_name, l.is_active,"
        " count(h.observed_at) as hours"
        " from gold.daily_canonical f join gold.dim_locations l on l.location_id = f.location_id"
        " left join stg_hourly h on h.location_id = f.location_id and h.p_date = f.dates"
        " group by all"
    )


def _outcome(guard) -> str:
    """What a guard says: the error's text without paths, or that it let the rows pass."""
    try:
        guard()
    except (ValueError, FileNotFoundError, PySparkException, Py4JJavaError) as error:
        text = re.sub(r"(?s)^.*USER_RAISED_EXCEPTION\] ", "", str(error))
        return re.sub(r"\s+SQLSTATE.*|\s+/\S+", "", text.split("\n")[0])
    return "pass"


def guard_verdicts(spark, sf_dir):
    """What each guard says to the driver's tables as they are, and with one thing broken in them."""
    places = bridge.locations(spark, sf_dir)
    hourly = materialize(bridge.bronze_hourly(spark, sf_dir), "source")
    vectors = bridge.table(spark, sf_dir, "embeddings")
    table = scratch_path(spark, "table")
    load(hourly, table, HOURLY)

    def zipped(size: Column) -> Column:
        values = {"value": F.slice(F.col("embedding").cast("array<double>"), F.lit(1), size)}
        return zip_series(F.sequence(F.lit(1), F.size("embedding")), values)

    def csv(rows: DataFrame) -> DataFrame:
        return locations.read_locations(spark, _write_locations(rows, scratch_path(spark, "csv")))

    unplaced = places.withColumn("latitude", F.expr("if(state = 'R1', null, latitude)"))
    cases = {
        "locations as they are": lambda: locations.active_locations(csv(places)),
        "locations without two columns": lambda: csv(places.drop("state", "timezone")),
        "no location is active": lambda: locations.active_locations(
            places.withColumn("is_active", F.lit("no"))
        ),
        "an active location without a place": lambda: locations.active_locations(unplaced),
        "batch without a key column": lambda: load(hourly.drop("observed_at"), table, HOURLY),
        "batch with an unknown column": lambda: load(
            hourly.withColumn("sleet", F.col("rain")), table, HOURLY
        ),
        "rows without a time": lambda: load(
            hourly.withColumn("observed_at", F.expr("if(rain > 1, null, observed_at)")),
            scratch_path(spark, "table"), HOURLY,
        ),
        "partitioned by a metric": lambda: write_partitioned(
            hourly, scratch_path(spark, "partitioned"), "rain"
        ),
        "one bound of a range": lambda: resolve_range(date(2024, 1, 25), 7, start="2024-01-01"),
        "series of equal length": lambda: vectors.select(
            F.inline(zipped(F.size("embedding")))
        ).count(),
        "series one value short": lambda: vectors.select(
            F.max(F.size(zipped(F.size("embedding") - 1)))
        ).collect(),
        "landing without files": lambda: read_landing(spark, table),
    }
    found = [(case, _outcome(guard)) for case, guard in cases.items()]
    return spark.createDataFrame(found, "guarded string, outcome string")


def partial_rebuild(spark, sf_dir):
    """Half the locations loaded and built, then the rest, then only the days that they touch."""
    warehouse = pipeline.Warehouse(spark, scratch_path(spark, "warehouse"))
    seed = _write_locations(bridge.locations(spark, sf_dir), scratch_path(spark, "locations"))
    later = F.expr("pmod(hash(location_id), 2) = 1")

    def arrive(these: Column) -> DateSet:
        def one(kind: Readings, rows) -> DateSet:
            return load(rows(spark, sf_dir).where(these), warehouse.bronze(kind), kind).dates

        sources = {HOURLY: bridge.bronze_hourly, DAILY: bridge.bronze_daily}
        jobs = {kind: partial(one, kind, rows) for kind, rows in sources.items()}
        hours, days = concurrently(spark, jobs).values()
        return hours | days

    arrive(~later)
    pipeline.build_models(warehouse, seed)
    pipeline.build_models(warehouse, seed, arrive(later))
    return read_table(spark, warehouse.path("gold", "fct_daily"))


def load_beside_reader(spark, sf_dir):
    """An upsert in its steps, with a reader that opened the table before, one that opens it while the
    load is written, and one that opens it after; all read when the load is over."""
    rows, path = bridge.bronze_hourly(spark, sf_dir), scratch_path(spark, "table")
    load(rows, path, HOURLY)
    readers = {"before": read_bronze(spark, path, HOURLY)}
    change = prepare_load(_next_hour(rows), path, HOURLY)
    readers["during"] = read_bronze(spark, path, HOURLY)
    change.publish()
    readers["after"] = read_bronze(spark, path, HOURLY)
    change.finish()
    return stack_by_name(
        [rows.withColumn("opened", F.lit(opened)) for opened, rows in readers.items()]
    )


def pending_during_build(spark, sf_dir):
    """Days that wait after a full build, while which one more batch was loaded."""
    warehouse = pipeline.Warehouse(spark, scratch_path(spark, "warehouse"))
    seed = _write_locations(bridge.locations(spark, sf_dir), scratch_path(spark, "locations"))
    hourly = materialize(bridge.bronze_hourly(spark, sf_dir), "source")
    late = F.expr("substring(location_id, 5) % 5 = 2 and day(p_date) % 4 = 1")

    def arrive(rows: DataFrame) -> None:
        pipeline.add_pending(warehouse, load(rows, warehouse.bronze(HOURLY), HOURLY).dates)

    arrive(hourly.where(~late))
    load(bridge.bronze_daily(spark, sf_dir), warehouse.bronze(DAILY), DAILY)
    pipeline.build_models(
        warehouse, seed,
        on_saved=lambda name: arrive(hourly.where(late)) if name == "hourly_enriched" else None,
    )
    days = sorted(pipeline.pending_dates(warehouse).days)
    return spark.createDataFrame([(day,) for day in days], "day date")


def rollup_incremental(spark, sf_dir):
    """The rollup as three deliveries leave it: some locations, then the others, then later readings
    of some days, which overwrite hours and bring new ones."""
    table, state = scratch_path(spark, "table"), scratch_path(spark, "state")
    rows = bridge.bronze_hourly(spark, sf_dir)
    some = F.expr("substring(location_id, 5) % 2 = 0")
    load_with_state(rows.where(some), table, state, "append")
    load_with_state(rows.where(~some), table, state, "append")
    load_with_state(_next_hour(rows).where("day(p_date) % 3 = 1"), table, state)
    return stored_rollup(spark, state)


def _two_builds(spark: SparkSession, sf_dir: str, between) -> pipeline.Warehouse:
    """A warehouse whose models were built twice, the second time for the days of a later load."""
    warehouse = pipeline.Warehouse(spark, scratch_path(spark, "warehouse"))
    seed = _write_locations(bridge.locations(spark, sf_dir), scratch_path(spark, "locations"))
    late = F.expr("substring(location_id, 5) % 4 = 3 and day(p_date) % 3 = 1")
    for part, dates in ((~late, False), (late, True)):
        touched = [
            load(rows(spark, sf_dir).where(part), warehouse.bronze(kind), kind).dates
            for kind, rows in ((HOURLY, bridge.bronze_hourly), (DAILY, bridge.bronze_daily))
        ]
        pipeline.build_models(warehouse, seed, touched[0] | touched[1] if dates else None)
        between(warehouse)
    return warehouse


def check_suite_incremental(spark, sf_dir):
    """All declared checks after a full and a partial build; the second time on changed days only."""
    reports = []
    _two_builds(spark, sf_dir, lambda warehouse: reports.append(pipeline.check_models(warehouse)[0]))
    return reports[-1]


def _followed_figures(spark: SparkSession, sf_dir: str) -> str:
    """Stored figures of the hourly table after two loads."""
    table, figures = scratch_path(spark, "table"), scratch_path(spark, "figures")
    rows = bridge.bronze_hourly(spark, sf_dir)
    for batch in (rows, _next_hour(rows).where("day(p_date) % 3 = 1")):
        load(batch, table, HOURLY)
        follow_figures(spark, table, figures, HOURLY)
    return figures


def column_statistics(spark, sf_dir):
    """Least, largest and absent values of each column, from stored figures of each date."""
    return column_figures(spark, _followed_figures(spark, sf_dir), HOURLY).where(
        "column not in ('observed_at', 'ingested_at')"
    )


def freshness_stored(spark, sf_dir):
    """The freshness rule on stored figures."""
    figures = _followed_figures(spark, sf_dir)
    return c.freshness({"hourly": newest(spark, figures)}, NOW)


def duplicate_count_stored(spark, sf_dir):
    """Rows, keys and repeats of a loaded table from stored figures."""
    return key_figures(spark, _followed_figures(spark, sf_dir))


def table_key_conflicts(spark, sf_dir):
    """Keys that would break a table's uniqueness."""
    return guards.repeated_keys(bridge.bronze_hourly(spark, sf_dir), HOURLY.keys)


def empty_load(spark, sf_dir):
    """A batch without rows changes nothing, whatever the mode."""
    rows = bridge.bronze_hourly(spark, sf_dir)
    return _loaded(spark, (rows, "upsert"), (rows.where("rain < -1"), "replace"))


def parquet_partition_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    write_partitioned(bridge.bronze_hourly(spark, sf_dir).drop("p_date"), path, "observed_at")
    return read_bronze(spark, path, HOURLY)


def union_by_name(spark, sf_dir):
    return stack_by_name(
        [bridge.bronze_hourly(spark, sf_dir), bridge.bronze_daily(spark, sf_dir)]
    )


def _shifted(rows: DataFrame, observed_at: Column) -> DataFrame:
    """A later delivery of the same readings under other keys, a little warmer."""
    return rows.withColumns(
        {
            "observed_at": observed_at,
            "ingested_at": F.col("ingested_at") + F.expr("interval 1 day"),
            "temperature_2m": F.col("temperature_2m") + 0.5,
        }
    ).withColumn("p_date", F.to_date("observed_at"))


def _next_hour(rows: DataFrame) -> DataFrame:
    """Moves each reading one hour on: some keys are in the table, some are new."""
    return _shifted(rows, F.col("observed_at") + F.expr("interval 1 hour"))


def _loaded(spark: SparkSession, *loads: tuple[DataFrame, str]) -> DataFrame:
    path = scratch_path(spark, "table")
    for batch, mode in loads:
        load(batch, path, HOURLY, mode)
    return read_bronze(spark, path, HOURLY)


def load_replace(spark, sf_dir):
    rows = bridge.bronze_hourly(spark, sf_dir)
    return _loaded(spark, (rows, "replace"), (_next_hour(rows), "replace"))


def load_append(spark, sf_dir):
    rows = bridge.bronze_hourly(spark, sf_dir)
    elsewhere = rows.withColumn("location_id", F.concat(F.lit("alt_"), "location_id"))
    return _loaded(spark, (rows, "append"), (elsewhere, "append"))


def load_upsert(spark, sf_dir):
    rows = bridge.bronze_hourly(spark, sf_dir)
    return _loaded(spark, (rows, "upsert"), (_next_hour(rows), "upsert"))


def load_upsert_older(spark, sf_dir):
    """A batch that is older than the table still wins."""
    rows = bridge.bronze_hourly(spark, sf_dir)
    return _loaded(spark, (_next_hour(rows), "upsert"), (rows, "upsert"))


def load_upsert_narrow(spark, sf_dir):
    """A batch with temperatures only leaves the other metrics of matched rows alone."""
    rows = bridge.bronze_hourly(spark, sf_dir)
    narrow = _next_hour(rows).select(*HOURLY.keys, "ingested_at", "temperature_2m")
    return _loaded(spark, (rows, "upsert"), (narrow, "upsert"))


def check_not_null(spark, sf_dir):
    check = c.Check("typed_hourly", c.NOT_NULL, ("temperature_2m",))
    return check.failing(typed_hourly(spark, sf_dir))


def check_unique(spark, sf_dir):
    check = c.Check("typed_hourly", c.UNIQUE, ("location_id",))
    return check.failing(typed_hourly(spark, sf_dir))


def check_unique_combination(spark, sf_dir):
    check = c.Check("typed_hourly", c.UNIQUE_COMBINATION, HOURLY.keys)
    return check.failing(typed_hourly(spark, sf_dir))


def check_accepted_values(spark, sf_dir):
    check = c.Check("hourly_enriched", c.ACCEPTED_VALUES, ("temp_bucket",), values=("cold", "mild"))
    return check.failing(hourly_enriched(spark, sf_dir)).select(
        "location_id", "observed_at", "temp_bucket"
    )


def check_expression(spark, sf_dir):
    check = c.Check(
        "typed_hourly",
        c.EXPRESSION,
        condition="temperature_2m is not null and temperature_2m >= -80 and temperature_2m < 70",
    )
    return check.failing(typed_hourly(spark, sf_dir))


def check_column_expression(spark, sf_dir):
    check = c.Check(
        "daily_rollup",
        c.COLUMN_EXPRESSION,
        ("temperature_2m_max_from_hourly",),
        "between -80 and 60",
    )
    return check.failing(daily_rollup(spark, sf_dir))


def check_freshness(spark, sf_dir):
    return c.freshness(
        {
            "hourly": bridge.bronze_hourly(spark, sf_dir),
            "daily": bridge.bronze_daily(spark, sf_dir),
        },
        NOW,
    )


def check_suite(spark, sf_dir):
    """All declared checks on all models; tables are written once to the shared folder."""
    models = model_tables(
        bridge.bronze_hourly(spark, sf_dir),
        bridge.bronze_daily(spark, sf_dir),
        bridge.locations(spark, sf_dir),
        save=lambda name, df: materialize(df, name),
    )
    return c.run_checks(models, declared_checks())


QUERIES = {
    query.__name__: query
    for query in (
        typed_hourly,
        typed_daily,
        dedup_hourly_latest,
        dedup_daily_latest,
        dedup_keep_last,
        hot_key_dedup,
        duplicate_count,
        hourly_bands,
        hourly_flags,
        hourly_enriched,
        daily_rollup,
        daily_enriched,
        daily_enriched_off_midnight,
        fct_daily_api,
        fct_daily_hourly,
        fct_daily,
        fct_daily_bucketed,
        fct_daily_ranged,
        fct_daily_quality,
        quality_status_counts,
        dim_locations,
        active_locations,
        series_explode,
        json_props,
        landing_roundtrip,
        landing_roundtrip_daily,
        landing_incremental,
        quarantined_rows,
        malformed_line_numbers,
        open_variables,
        locations_csv,
        pipeline_fct_daily,
        pipeline_quality,
        tables_by_name,
        guard_verdicts,
        partial_rebuild,
        load_beside_reader,
        rollup_incremental,
        check_suite_incremental,
        column_statistics,
        freshness_stored,
        duplicate_count_stored,
        pending_during_build,
        table_key_conflicts,
        empty_load,
        parquet_partition_roundtrip,
        union_by_name,
        load_replace,
        load_append,
        load_upsert,
        load_upsert_older,
        load_upsert_narrow,
        check_not_null,
        check_unique,
        check_unique_combination,
        check_accepted_values,
        check_expression,
        check_column_expression,
        check_freshness,
        check_suite,
    )
}
