"""The daily rollup as a stored state that loads add to.

The state holds, for each location and day, sums, counts, least and largest values, which two sets of
hours can be merged by. A load changes the cells (location and day) of its batch only: new hours are
merged into them, and cells in which it overwrote hours are computed again from their rows. So an
append reads no stored hour, and an upsert those of the cells it overwrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.operators import snapshots
from rainfold.operators.derived import Stale, replace_days, stale
from rainfold.operators.snapshots import read_snapshot, read_table
from rainfold.operators.tables import PARTITION, Change, LoadReport, prepare_load
from rainfold.schemas import HOURLY

CELL = ("location_id", PARTITION)
# State column: its aggregate over hours, and how two states' columns merge.
PARTS = {
    "temperature_max": ("max(temperature_2m)", "max"),
    "temperature_min": ("min(temperature_2m)", "min"),
    "temperature_sum": ("sum(temperature_2m)", "sum"),
    "temperature_hours": ("count(temperature_2m)", "sum"),
    "rain_sum": ("sum(coalesce(rain, 0d))", "sum"),
    "precipitation_sum": ("sum(coalesce(precipitation, 0d))", "sum"),
    "snowfall_sum": ("sum(coalesce(snowfall, 0d))", "sum"),
    "wind_max": ("max(wind_speed_10m)", "max"),
    "wind_sum": ("sum(wind_speed_10m)", "sum"),
    "wind_hours": ("count(wind_speed_10m)", "sum"),
    "precip_hours": ("count_if(precipitation > 0)", "sum"),
    "rain_hours": ("count_if(rain > 0)", "sum"),
    "snowfall_hours": ("count_if(snowfall > 0)", "sum"),
    "latest_ingested_at": ("max(ingested_at)", "max"),
}
# Column of the rollup: its value from the state.
FINISHED = {
    "temperature_2m_max_from_hourly": "temperature_max",
    "temperature_2m_min_from_hourly": "temperature_min",
    "temperature_2m_mean_from_hourly": "temperature_sum / nullif(temperature_hours, 0)",
    "rain_sum_from_hourly": "rain_sum",
    "precipitation_sum_from_hourly": "precipitation_sum",
    "snowfall_sum_from_hourly": "snowfall_sum",
    "wind_speed_10m_max": "wind_max",
    "wind_speed_10m_mean": "wind_sum / nullif(wind_hours, 0)",
    "precip_hours": "precip_hours",
    "rain_hours": "rain_hours",
    "snowfall_hours": "snowfall_hours",
    "hourly_latest_ingested_at": "latest_ingested_at",
}


def partial_days(hourly: DataFrame) -> DataFrame:
    """The state of a set of hours."""
    return hourly.groupBy(*CELL).agg(
        *[F.expr(f"{over_hours} as {name}") for name, (over_hours, _) in PARTS.items()]
    )


def merged_days(states: DataFrame) -> DataFrame:
    """One row per cell from several states of it."""
    return states.groupBy(*CELL).agg(
        *[F.expr(f"{merge}({name}) as {name}") for name, (_, merge) in PARTS.items()]
    )


def rollup_of(state: DataFrame) -> DataFrame:
    """The rollup that ``roll_up_to_days`` gives for the same hours."""
    return state.selectExpr(
        "location_id", f"{PARTITION} as dates",
        *[f"{value} as {name}" for name, value in FINISHED.items()],
    )


def next_state(spark: SparkSession, path: str, found: Stale, change: Change) -> DataFrame:
    """The state of a load's days after it, from the state before and the batch.

    Only rows of cells in which the load overwrote hours are read from the table.
    """
    keys = list(HOURLY.keys)
    touched = [part for part in change.before.live if part in found.changed]
    before = read_snapshot(spark, change.path, change.before, touched).select(*keys)
    batch = change.staged
    if change.report.mode == "append" or not touched:
        # The load has made sure that no key of the batch was there.
        added = partial_days(_all_metrics(batch))
        return merged_days(_state_of(spark, path, found, touched).unionByName(added))
    overwritten = batch.join(before, keys, "left_semi").select(*CELL).distinct()
    added = partial_days(_all_metrics(batch.join(overwritten, list(CELL), "left_anti")))
    kept = _state_of(spark, path, found, touched).join(overwritten, list(CELL), "left_anti")
    after = read_snapshot(spark, change.path, found.source, found.changed)
    again = partial_days(after.join(overwritten, list(CELL), "left_semi"))
    return merged_days(kept.unionByName(added)).unionByName(again)


def _all_metrics(batch: DataFrame) -> DataFrame:
    absent = {m: F.lit(None).cast("double") for m in HOURLY.metrics if m not in batch.columns}
    if "ingested_at" not in batch.columns:
        absent["ingested_at"] = F.lit(None).cast("timestamp_ntz")
    return batch.withColumns(absent)


def _state_of(spark: SparkSession, path: str, found: Stale, parts: list[str]) -> DataFrame:
    return read_snapshot(spark, path, found.derived, parts)


def load_with_state(
    batch: DataFrame, path: str, state_path: str, mode: str = "upsert"
) -> LoadReport:
    """Load hourly rows and bring the daily state up to date.

    The state notes which loads it shows. Where it had fallen behind before this load, after a run
    that died between the two for instance, and after a ``replace``, its stale days are computed from
    the table.
    """
    spark = batch.sparkSession
    change = prepare_load(batch, path, HOURLY, mode)
    try:
        behind = change.before is None or _is_behind(spark, state_path, change)
        change.publish()
        if change.after is None:
            return change.report
        found = stale(spark, path, state_path)
        if behind or mode == "replace":
            rows = partial_days(read_snapshot(spark, path, found.source, found.changed))
        else:
            rows = next_state(spark, state_path, found, change)
        replace_days(rows, state_path, PARTITION, found)
    finally:
        change.finish()
    return change.report


def _is_behind(spark: SparkSession, state_path: str, change: Change) -> bool:
    state = snapshots.current(spark, state_path)
    return state is None or state.made_from != change.before.live


def stored_rollup(spark: SparkSession, state_path: str) -> DataFrame:
    """The rollup as of the last load."""
    return rollup_of(read_table(spark, state_path))
