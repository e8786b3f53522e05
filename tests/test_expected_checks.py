from rainfold.functions import bands
from rainfold.operators.checks import run_checks
from rainfold.plans.declared_checks import declared_checks
from rainfold.plans.enriched import hourly_enriched
from rainfold.workload.expected_checks import EXPECTED
from tests.helpers import hourly_rows


def test_declared_checks_are_the_expected_ones():
    assert [(c.table, c.name) for c in declared_checks()] == [(t, n) for t, n, _ in EXPECTED]
    assert len(EXPECTED) == 107


def test_a_changed_band_bound_breaks_an_invariant(spark, monkeypatch):
    rows = hourly_rows(spark, {"observed_at": "2024-01-01T05:00:00", "temperature_2m": 14.0})
    checks = [
        c for c in declared_checks() if c.table == "hourly_enriched" and "temp_bucket" in c.name
    ]

    def failures():
        report = run_checks({"hourly_enriched": hourly_enriched(rows)}, checks)
        return sum(r.failures for r in report.collect())

    assert failures() == 0
    wrong = bands.Banding("temperature_2m", ((0, "freezing"), (12, "cold"), (25, "mild")), "hot")
    monkeypatch.setitem(bands.BANDINGS, "temp_bucket", wrong)
    assert failures() == 1
