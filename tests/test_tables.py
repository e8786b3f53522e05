import os

import pytest
from pyspark.sql import functions as F

from rainfold.operators import snapshots, tables
from rainfold.operators.guards import KeyConflict, require_columns, require_unique
from rainfold.operators.snapshots import current, read_table
from rainfold.operators.tables import load, read_bronze, write_partitioned, write_table
from rainfold.schemas import DAILY, HOURLY
from rainfold.functions.dates import DateRange
from tests.helpers import daily_rows, hourly_rows, records, ts


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def contents(spark, path, *columns):
    return records(read_bronze(spark, path, HOURLY), *columns)


def row(hour: int, rain=None, day=1, **more):
    return {"observed_at": f"2024-01-{day:02}T{hour:02}:00", "rain": rain} | more


def test_partitioned_write_and_read(spark, path):
    rows = hourly_rows(spark, row(23, 1.0), row(0, 2.0, day=2))
    write_partitioned(rows.drop("p_date"), path, "observed_at")
    assert sorted(n for n in os.listdir(path) if n.startswith("p_")) == [
        "p_date=2024-01-01", "p_date=2024-01-02"]
    assert contents(spark, path) == records(rows)
    assert read_table(spark, path).schema["p_date"].dataType.simpleString() == "date"


def test_partitioned_write_replaces_even_with_nothing(spark, path):
    rows = hourly_rows(spark, row(1))
    write_partitioned(rows, path, "observed_at")
    write_partitioned(rows.limit(0), path, "observed_at")
    assert contents(spark, path) == []


def test_partition_column_must_be_a_time_column(spark, path):
    with pytest.raises(ValueError, match="date.*observed_at"):
        write_partitioned(hourly_rows(spark, row(1)), path, "rain")
    assert not os.path.exists(path)


def test_hot_date_is_split_over_files(spark, path):
    """One date with almost all rows does not end in one task."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "65536")
    try:
        rows = spark.range(0, 200_000, 1, 8).select(
            F.concat(F.lit("l"), "id").alias("location_id"),
            F.lit("2024-01-01T05:00").cast("timestamp_ntz").alias("observed_at"),
            F.rand(1).alias("rain"),
        )
        write_partitioned(rows, path, "observed_at")
        [folder] = current(spark, path).folders
        assert len([n for n in os.listdir(f"{path}/{folder}") if n.endswith(".parquet")]) > 4
        assert read_table(spark, path).count() == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_table_rebuild_of_some_dates_leaves_others(spark, path):
    old = hourly_rows(spark, row(1, 1.0), row(1, 2.0, day=2))
    write_table(old, path, "p_date")
    day = DateRange(ts("2024-01-02").date(), ts("2024-01-02").date())
    new = hourly_rows(spark, row(1, 9.0, day=2))
    assert records(write_table(new, path, "p_date", day), "rain") == [(1.0,), (9.0,)]
    assert records(write_table(new, path, "p_date"), "rain") == [(9.0,)]


def test_load_reports_duplicates(spark, path):
    batch = hourly_rows(
        spark, row(1, 1.0, ingested_at="2024-01-02"), row(1, 2.0, ingested_at="2024-01-03"),
        row(2, 3.0))
    report = load(batch, path, HOURLY)
    assert (report.rows_read, report.rows_loaded, report.duplicates) == (3, 2, 1)
    assert report.dates.days == {ts("2024-01-01").date()}
    assert contents(spark, path, "rain") == [(2.0,), (3.0,)]


@pytest.mark.parametrize("mode", tables.MODES)
def test_empty_batch_changes_nothing(spark, path, mode):
    empty = hourly_rows(spark, row(1)).limit(0)
    assert load(empty, path, HOURLY, mode).skipped
    assert not os.path.exists(path)
    load(hourly_rows(spark, row(1, 1.0)), path, HOURLY)
    assert load(empty, path, HOURLY, mode).skipped
    assert contents(spark, path, "rain") == [(1.0,)]


def test_replace(spark, path):
    load(hourly_rows(spark, row(1, 1.0), row(1, 1.0, day=2)), path, HOURLY, "replace")
    load(hourly_rows(spark, row(2, 2.0, day=2)), path, HOURLY, "replace")
    assert contents(spark, path, "rain") == [(2.0,)]


def test_append_refuses_known_keys_and_leaves_the_table(spark, path):
    load(hourly_rows(spark, row(1, 1.0)), path, HOURLY, "append")
    load(hourly_rows(spark, row(2, 2.0)), path, HOURLY, "append")
    with pytest.raises(KeyConflict):
        load(hourly_rows(spark, row(2, 9.0), row(3, 9.0)), path, HOURLY, "append")
    assert contents(spark, path, "rain") == [(1.0,), (2.0,)]


def test_null_keys_never_conflict(spark, path):
    nameless = hourly_rows(spark, row(1, 1.0, location_id=None))
    for mode in ("append", "append", "upsert"):
        load(nameless, path, HOURLY, mode)
    assert contents(spark, path, "rain") == [(1.0,)] * 3


def test_upsert_inserts_and_overwrites(spark, path):
    load(hourly_rows(spark, row(1, 1.0), row(2, 2.0), row(1, 5.0, day=9)), path, HOURLY)
    load(hourly_rows(spark, row(2, 8.0), row(3, 9.0)), path, HOURLY)
    assert contents(spark, path, "rain") == [(1.0,), (5.0,), (8.0,), (9.0,)]


def test_upsert_twice_equals_once(spark, path):
    batch = hourly_rows(spark, row(1, 1.0), row(2, 2.0, day=3))
    load(batch, path, HOURLY)
    once = contents(spark, path)
    load(batch, path, HOURLY)
    assert contents(spark, path) == once


def test_older_batch_still_wins(spark, path):
    load(hourly_rows(spark, row(1, 1.0, ingested_at="2024-02-02")), path, HOURLY)
    load(hourly_rows(spark, row(1, 2.0, ingested_at="2024-02-01")), path, HOURLY)
    assert contents(spark, path, "rain") == [(2.0,)]


def test_upsert_only_rewrites_touched_dates(spark, path):
    load(hourly_rows(spark, row(1, day=1), row(1, day=2), row(1, day=3)), path, HOURLY)

    before = current(spark, path).live
    load(hourly_rows(spark, row(2, day=1), row(2, day=3)), path, HOURLY)
    after = current(spark, path).live
    assert [after[part] == before[part] for part in sorted(before)] == [False, True, False]


def test_narrow_batch_keeps_other_columns(spark, path):
    load(hourly_rows(spark, row(1, 1.0, snowfall=5.0), row(2, 2.0, snowfall=6.0)), path, HOURLY)
    batch = hourly_rows(spark, row(2, None), row(3, 3.0)).select(*HOURLY.keys, "rain")
    load(batch, path, HOURLY)
    assert contents(spark, path, "rain", "snowfall") == [(1.0, 5.0), (3.0, None), (None, 6.0)]


def test_batch_of_keys_only_does_nothing_to_known_rows(spark, path):
    load(hourly_rows(spark, row(1, 1.0)), path, HOURLY)
    load(hourly_rows(spark, row(1), row(2)).select(*HOURLY.keys), path, HOURLY)
    assert contents(spark, path, "observed_at", "rain") == [
        (ts("2024-01-01T01:00"), 1.0), (ts("2024-01-01T02:00"), None)]


def test_bad_batches(spark, path):
    rows = hourly_rows(spark, row(1))
    with pytest.raises(ValueError, match="mode"):
        load(rows, path, HOURLY, "merge")
    with pytest.raises(ValueError, match=r"lacks columns: \['observed_at'\]"):
        load(rows.drop("observed_at"), path, HOURLY)
    with pytest.raises(ValueError, match="the table lacks"):
        load(rows.withColumn("sleet", F.lit(1.0)), path, HOURLY)
    with pytest.raises(ValueError, match="quarantine"):
        load(hourly_rows(spark, {"observed_at": None}), path, HOURLY)


def test_daily_table(spark, path):
    load(daily_rows(spark, {"date": "2024-01-01", "rain_sum": 1.0}), path, DAILY)
    load(daily_rows(spark, {"date": "2024-01-01", "rain_sum": 2.0}), path, DAILY)
    assert records(read_bronze(spark, path, DAILY), "rain_sum") == [(2.0,)]


def test_a_load_that_dies_before_its_end_leaves_the_table(spark, path, monkeypatch):
    load(hourly_rows(spark, row(1, 1.0), row(2, 2.0)), path, HOURLY)
    with monkeypatch.context() as patch:
        def die(*_):
            raise RuntimeError("driver lost")

        patch.setattr(snapshots, "publish", die)
        with pytest.raises(RuntimeError):
            load(hourly_rows(spark, row(2, 9.0)), path, HOURLY)
    assert contents(spark, path, "rain") == [(1.0,), (2.0,)]
    load(hourly_rows(spark, row(3, 3.0)), path, HOURLY)
    assert contents(spark, path, "rain") == [(1.0,), (2.0,), (3.0,)]


@pytest.mark.parametrize("mode", tables.MODES)
def test_readers_see_a_load_whole_or_not_at_all(spark, path, mode):
    day = 2 if mode == "append" else 1
    load(hourly_rows(spark, row(1, 1.0), row(2, 2.0)), path, HOURLY)
    opened_before = read_bronze(spark, path, HOURLY)
    old = contents(spark, path, "rain")
    change = tables.prepare_load(hourly_rows(spark, row(2, 9.0, day=day)), path, HOURLY, mode)
    assert contents(spark, path, "rain") == old
    change.publish()
    opened_after = read_bronze(spark, path, HOURLY)
    change.finish()
    new = {"replace": [9.0], "append": [1.0, 2.0, 9.0], "upsert": [1.0, 9.0]}[mode]
    assert records(opened_after, "rain") == [(x,) for x in new]
    assert records(opened_before, "rain") == old


def test_replaced_folders_go_when_they_are_old_enough(spark, path, monkeypatch):
    load(hourly_rows(spark, row(1, 1.0)), path, HOURLY)
    [first] = current(spark, path).folders
    load(hourly_rows(spark, row(1, 2.0)), path, HOURLY)
    [second] = current(spark, path).folders
    load(hourly_rows(spark, row(1, 3.0)), path, HOURLY)
    assert os.path.exists(f"{path}/{first}") and os.path.exists(f"{path}/{second}")
    monkeypatch.setattr(snapshots, "KEEP_SECONDS", -1)
    load(hourly_rows(spark, row(1, 4.0)), path, HOURLY)
    assert not os.path.exists(f"{path}/{first}") and not os.path.exists(f"{path}/{second}")
    assert len(current(spark, path).gone) == 1
    assert contents(spark, path, "rain") == [(4.0,)]


def test_plain_folders_can_be_read_but_not_loaded(spark, path):
    rows = hourly_rows(spark, row(1, 1.0), row(2, 2.0, day=2))
    rows.write.partitionBy("p_date").parquet(path)
    assert contents(spark, path) == records(rows)
    with pytest.raises(ValueError, match="no load of this library"):
        load(rows, path, HOURLY)


def test_a_table_grows_by_a_load(spark, path):
    load(hourly_rows(spark, row(1, 1.0), row(2, 2.0)), path, HOURLY)
    wide = hourly_rows(spark, row(2, 5.0), row(3, 6.0)).withColumn("sleet", F.col("rain") * 2)
    load(wide, path, HOURLY, grow=True)
    load(hourly_rows(spark, row(3, 7.0), row(4, 8.0)).select(*HOURLY.keys, "rain"), path, HOURLY)
    load(hourly_rows(spark, row(9, 9.0, day=2)), path, HOURLY)
    assert read_bronze(spark, path, HOURLY).columns[-2:] == ["sleet", "p_date"]
    assert contents(spark, path, "rain", "sleet") == [
        (1.0, None), (5.0, 10.0), (7.0, 12.0), (8.0, None), (9.0, None)]
    text = hourly_rows(spark, row(5)).withColumn("sleet", F.lit("much"))
    with pytest.raises(ValueError, match="sleet"):
        load(text, path, HOURLY, grow=True)


def test_guards(spark):
    rows = hourly_rows(spark, row(1), row(1), row(2, location_id=None), row(2, location_id=None))
    with pytest.raises(KeyConflict):
        require_unique(rows, HOURLY.keys, "rows")
    require_unique(rows.where("location_id is null"), HOURLY.keys, "rows")
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        require_columns(rows, ["y", "rain", "x"], "rows")


def twice(spark, path):
    """A table of other making, which holds a key twice."""
    rows = hourly_rows(spark, row(1), row(2), row(2))
    write_partitioned(rows, path, "observed_at")


def test_table_key_guard(spark, path):
    load(hourly_rows(spark, row(1), row(2)), path, HOURLY)
    tables.require_table_keys(spark, path, HOURLY)
    twice(spark, path)
    with pytest.raises(KeyConflict, match="table"):
        tables.require_table_keys(spark, path, HOURLY)


def test_a_table_that_holds_a_key_twice_takes_no_load(spark, path):
    twice(spark, path)
    for mode in ("append", "upsert"):
        with pytest.raises(KeyConflict):
            load(hourly_rows(spark, row(1, 3.0, day=5)), path, HOURLY, mode)
    load(hourly_rows(spark, row(2, 3.0)), path, HOURLY, "replace")
    load(hourly_rows(spark, row(2, 4.0)), path, HOURLY)
    assert contents(spark, path, "rain") == [(4.0,)]


def test_tables_are_queryable_by_name(spark, path):
    write_table(hourly_rows(spark, row(1, 1.0), row(1, 7.0, day=9)), path, "p_date")
    tables.register(spark, "silver_t", "readings", path, "p_date")
    write_table(hourly_rows(spark, row(1, 2.0), row(1, 3.0, day=2)), path, "p_date")
    tables.register(spark, "silver_t", "readings", path, "p_date")
    found = spark.sql("select rain from silver_t.readings where p_date >= date'2024-01-01'")
    assert records(found) == [(2.0,), (3.0,)]
    spark.sql("drop table silver_t.readings")


def test_upsert_does_not_need_sparks_mark_of_success(spark, path):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        load(hourly_rows(spark, row(1, 1.0), row(2, 2.0)), path, HOURLY)
        load(hourly_rows(spark, row(2, 8.0), row(3, 9.0)), path, HOURLY)
        assert contents(spark, path, "rain") == [(1.0,), (8.0,), (9.0,)]
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_replace_names_old_days_too_and_rebuilds_drop_empty_days(spark, path):
    load(hourly_rows(spark, row(1, 1.0), row(1, 2.0, day=2)), path, HOURLY)
    report = load(hourly_rows(spark, row(1, 3.0, day=2)), path, HOURLY, "replace")
    assert sorted(d.day for d in report.dates.days) == [1, 2]
    target = path + "-model"
    write_table(hourly_rows(spark, row(1, 1.0), row(1, 2.0, day=2)), target, "p_date")
    now = tables.read_bronze(spark, path, HOURLY)
    assert records(write_table(now, target, "p_date", report.dates), "rain") == [(3.0,)]


def test_an_upsert_moves_stored_rows_only_where_it_overwrites_some(spark, path, monkeypatch):
    load(hourly_rows(spark, row(1, 1.0), row(1, 2.0, day=2), row(1, 3.0, day=3)), path, HOURLY)
    before = current(spark, path).live
    new = [row(2, 4.0), row(1, 9.0, day=2), row(2, 5.0, day=2), row(1, 6.0, day=3, location_id=None)]
    report = load(hourly_rows(spark, *new, row(2, 0.0, ingested_at="2023-01-01")), path, HOURLY)
    assert (report.rows_read, report.rows_loaded, len(report.dates.days)) == (5, 4, 3)
    after = current(spark, path).live
    kept = {part[-2:]: after[part][0] == before[part][0] for part in before}
    assert kept == {"01": True, "02": False, "03": True}
    assert sorted(len(loads) for loads in after.values()) == [1, 2, 2]
    assert contents(spark, path, "rain") == [(1.0,), (3.0,), (4.0,), (5.0,), (6.0,), (9.0,)]
    monkeypatch.setattr(tables, "MOST_LOADS", 2)
    load(hourly_rows(spark, row(5, 7.0)).select(*HOURLY.keys, "rain"), path, HOURLY)
    assert len(current(spark, path).live["p_date=2024-01-01"]) == 1
    assert contents(spark, path, "rain")[:3] == [(1.0,), (3.0,), (4.0,)]
    assert read_bronze(spark, path, HOURLY).count() == 7


def test_a_load_of_new_days_is_written_once(spark, path, monkeypatch):
    monkeypatch.setattr(tables, "_stage", None)
    load(hourly_rows(spark, row(1, 1.0), row(1, 2.0)), path, HOURLY)
    load(hourly_rows(spark, row(1, 3.0, day=2)).select(*HOURLY.keys, "rain"), path, HOURLY, "append")
    load(hourly_rows(spark, row(1, 4.0, day=3)), path, HOURLY, "upsert")
    assert read_bronze(spark, path, HOURLY).count() == 3
    load(hourly_rows(spark, row(1, 5.0), row(1, 6.0)), path, HOURLY, "replace")
    assert read_bronze(spark, path, HOURLY).count() == 1
