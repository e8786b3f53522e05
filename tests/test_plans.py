"""Physical plans keep the shape that scales."""

import pytest
from pyspark.sql import functions as F

from rainfold.functions.dates import DateRange
from rainfold.operators.rollup import roll_up_to_days
from rainfold.operators.tables import read_bronze, write_partitioned
from rainfold.plans import colocated
from rainfold.plans.colocated import save_bucketed
from rainfold.plans.enriched import hourly_enriched, pair_daily
from rainfold.plans.facts import fct_daily, fct_daily_quality
from rainfold.plans.staging import stg_daily, stg_hourly
from rainfold.schemas import DAILY, HOURLY
from tests.helpers import daily_rows, hourly_rows, records, ts


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    write_partitioned(
        hourly_rows(spark, *[{"observed_at": f"2024-01-{d:02}T05:00"} for d in (1, 2, 3)]),
        f"{root}/h", "observed_at")
    write_partitioned(
        daily_rows(spark, *[{"date": f"2024-01-{d:02}"} for d in (1, 2, 3)]), f"{root}/d", "date")
    return read_bronze(spark, f"{root}/h", HOURLY), read_bronze(spark, f"{root}/d", DAILY)


def pairs(bronze, dates=None):
    hourly, daily = bronze
    rollup = roll_up_to_days(hourly_enriched(stg_hourly(hourly, dates)))
    return pair_daily(stg_daily(daily, dates), rollup)


def test_dedup_drops_losers_before_the_shuffle(bronze):
    text = plan(stg_hourly(bronze[0]))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1
    assert text.rindex("Partial") > text.index("Exchange") > text.index("Final")


def test_rollup_combines_before_the_shuffle(bronze):
    text = plan(roll_up_to_days(bronze[0]))
    assert text.count("Exchange") == 1 and "partial_max" in text and "partial_sum" in text


@pytest.mark.parametrize("fact", [fct_daily, fct_daily_quality])
def test_facts_scan_each_source_once_and_join_once(bronze, fact):
    text = plan(fact(pairs(bronze)))
    assert text.count("FileScan") == 2
    assert text.count("FullOuter") == 1
    # Two dedups, the rollup, and the feed once more by day; the rollup joins where it is.
    assert text.count("Exchange hashpartitioning") == 4


def test_range_prunes_partitions_of_both_sources(bronze):
    dates = DateRange(ts("2024-01-02").date(), ts("2024-01-03").date())
    text = plan(fct_daily(pairs(bronze, dates)))
    filters = [part for part in text.split("PartitionFilters: ")[1:]]
    assert len(filters) == 2
    assert all("p_date" in part.split("]")[0] for part in filters)


def test_key_filters_reach_the_scan(bronze):
    text = plan(stg_hourly(bronze[0]).where("location_id = 'a'"))
    assert "EqualTo(location_id,a)" in text


def test_no_python_in_plans(bronze):
    text = plan(fct_daily_quality(pairs(bronze)))
    assert "Python" not in text and "Arrow" not in text
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_bucketed_tables_need_no_exchange(spark, bronze):
    """From bronze to fact, whatever the sizes; a hot location spreads over its days."""
    hourly, daily = bronze
    many = spark.range(40_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('l', id % 700)) as location_id",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id % 4000 as int)) as observed_at",
        "timestamp_ntz'2024-03-01' as ingested_at", "double(id % 7) as rain",
    )
    rows = hourly.unionByName(many.withColumn("p_date", F.to_date("observed_at")), True)
    save_bucketed(rows, "bucketed_h", 16)
    save_bucketed(daily, "bucketed_d", 16)
    broadcasts = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        paired = colocated.pair_daily(spark, "bucketed_h", "bucketed_d")
        for fact in (fct_daily, fct_daily_quality):
            text = plan(fact(paired))
            assert "Exchange" not in text and text.count("FullOuter") == 1
        plain = pairs((rows, daily))
        assert records(fct_daily(paired)) == records(fct_daily(plain))
        files = spark.table("bucketed_h").groupBy(F.input_file_name()).count()
        most = files.agg({"count": "max"}).first()[0]
        assert most < 2.5 * 40_000 / 16
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)
        for table in ("bucketed_h", "bucketed_d"):
            spark.sql(f"drop table {table}")
