from datetime import datetime, timezone
from collections import Counter

import pytest

from rainfold.operators import checks as c
from rainfold.operators.checks import Check, freshness, run_checks
from rainfold.plans.declared_checks import declared_checks
from tests.helpers import hourly_rows, records


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [("a", 1.0, "x"), ("a", -1.0, "y"), (None, None, None), (None, 3.0, "x")],
        "k string, v double, label string",
    )


CASES = [
    (Check("t", c.NOT_NULL, ("k",)), 2),
    (Check("t", c.NOT_NULL, ("v",)), 1),
    (Check("t", c.UNIQUE, ("k",)), 1),
    (Check("t", c.UNIQUE, ("v",)), 0),
    (Check("t", c.UNIQUE_COMBINATION, ("k",)), 2),
    (Check("t", c.UNIQUE_COMBINATION, ("k", "v")), 0),
    (Check("t", c.ACCEPTED_VALUES, ("label",), values=("x",)), 1),
    (Check("t", c.EXPRESSION, condition="v >= 0"), 1),
    (Check("t", c.EXPRESSION, condition="v is not null and v >= 0"), 2),
    (Check("t", c.COLUMN_EXPRESSION, ("v",), "between 0 and 2"), 2),
    (Check("t", c.COLUMN_EXPRESSION, ("v",), "is null or v < 10"), 0),
]


@pytest.mark.parametrize("check, failures", CASES, ids=[check.name for check, _ in CASES])
def test_failing_rows(frame, check, failures):
    assert check.failing(frame).count() == failures


def test_report_has_one_row_per_check(frame):
    report = run_checks({"t": frame}, [check for check, _ in CASES])
    assert report.columns == ["table", "check", "failures", "status"]
    assert records(report) == sorted(
        [("t", check.name, n, "fail" if n else "pass") for check, n in CASES], key=repr)


def test_row_checks_of_a_table_share_one_scan(frame):
    row_checks = [check for check, _ in CASES if not check.counts_keys]
    plan = run_checks({"t": frame}, row_checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_declared_checks():
    declared = declared_checks()
    assert len(declared) == 107
    assert len({(check.table, check.name) for check in declared}) == 107
    assert Counter(check.kind for check in declared) == {
        c.NOT_NULL: 26, c.UNIQUE: 1, c.UNIQUE_COMBINATION: 8, c.ACCEPTED_VALUES: 8,
        c.EXPRESSION: 22, c.COLUMN_EXPRESSION: 42}
    assert Counter(check.table for check in declared) == {
        "stg_daily": 12, "stg_hourly": 12, "hourly_enriched": 15, "daily_enriched": 18,
        "dim_locations": 4, "fct_daily_api": 10, "fct_daily_hourly": 14, "fct_daily": 17,
        "fct_daily_quality": 5}


@pytest.mark.parametrize(
    "day, status",
    [("2024-02-08", "pass"), ("2024-02-09", "warn"), ("2024-03-02", "warn"),
     ("2024-03-03", "error")],
)
def test_freshness_limits(spark, day, status):
    rows = hourly_rows(
        spark,
        {"observed_at": "2024-01-01", "ingested_at": "2024-02-01"},
        {"observed_at": "2024-01-01", "ingested_at": "2024-01-01"},
    )
    now = datetime.fromisoformat(day)
    assert records(freshness({"s": rows}, now), "source", "status") == [("s", status)]
    aware = now.replace(tzinfo=timezone.utc)
    assert records(freshness({"s": rows}, aware), "source", "status") == [("s", status)]


def test_empty_source_is_an_error(spark):
    empty = hourly_rows(spark, {"observed_at": "2024-01-01"}).limit(0)
    assert records(freshness({"s": empty}, datetime(2024, 1, 1)), "max_loaded_at", "status") == [
        (None, "error")]


def test_keys_of_tables_that_share_rows_are_counted_once(spark):
    rows = hourly_rows(spark, *[{"observed_at": "2024-01-01T01:00"}] * 2, {"observed_at": "2024-01-02"})
    keys = ("location_id", "observed_at")
    declared = [Check(table, c.UNIQUE_COMBINATION, keys) for table in ("stored", "staged")]
    found = c.failures_by_date(rows, "p_date", declared)
    assert records(found, "table", "failures") == [("staged", 1), ("stored", 1)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("count(1)") == 2
