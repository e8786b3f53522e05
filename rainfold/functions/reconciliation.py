"""SQL expressions that compare and combine the two sources of one daily fact."""

from __future__ import annotations

# Provenance and status labels, tolerances, decimals of the score.
HOURLY_SOURCE = "hourly_derived"
FEED_SOURCE = "api_daily"
STATUS_OK = "ok"
STATUS_WARNING = "warning"
STATUS_MISSING = "missing_hourly"
TEMPERATURE_TOLERANCE = 2
PRECIPITATION_TOLERANCE = 5
SCORE_DECIMALS = 2


def provenance(from_hourly: str | None, from_feed: str) -> str:
    """Name of the source that supplies the value; null when neither does."""
    feed = f"if({from_feed} is not null, '{FEED_SOURCE}', null)"
    if from_hourly is None:
        return feed
    return f"if({from_hourly} is not null, '{HOURLY_SOURCE}', {feed})"


def completeness(metrics: list[str]) -> str:
    """Share of metrics that are present, as a decimal rounded half up."""
    present = " + ".join(f"int({metric} is not null)" for metric in metrics)
    return f"round(cast({present} as decimal(10,0)) / {len(metrics)}, {SCORE_DECIMALS})"


def reconciliation_status(temp_max_gap: str, temp_min_gap: str, precip_gap: str) -> str:
    """An absent precipitation gap is ``missing_hourly``; absent temperature gaps count as none."""
    tolerances = {
        temp_max_gap: TEMPERATURE_TOLERANCE,
        temp_min_gap: TEMPERATURE_TOLERANCE,
        precip_gap: PRECIPITATION_TOLERANCE,
    }
    agrees = " and ".join(f"coalesce({gap} <= {limit}, true)" for gap, limit in tolerances.items())
    agreed = f"if({agrees}, '{STATUS_OK}', '{STATUS_WARNING}')"
    return f"if({precip_gap} is null, '{STATUS_MISSING}', {agreed})"
