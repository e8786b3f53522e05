"""The checks declared on the nine tables, built from rules.

Fixed values throughout: which columns are keys, labels, ranges and limits.
"""

from __future__ import annotations

from rainfold.functions.bands import FLAGS
from rainfold.functions.reconciliation import (
    FEED_SOURCE,
    HOURLY_SOURCE,
    STATUS_MISSING,
    STATUS_OK,
    STATUS_WARNING,
)
from rainfold.operators.checks import (
    ACCEPTED_VALUES,
    COLUMN_EXPRESSION,
    EXPRESSION,
    NOT_NULL,
    UNIQUE,
    UNIQUE_COMBINATION,
    Check,
)
from rainfold.plans.facts import HOUR_COUNTS, SUMS, TEMPERATURES, WINDS

REQUIRED = {
    "stg_daily": ("location_id", "dates", "p_date", "ingested_at"),
    "stg_hourly": ("location_id", "observed_at", "ingested_at", "p_date"),
    "hourly_enriched": ("location_id", "observed_at", "p_date"),
    "daily_enriched": ("location_id", "dates", "daily_ingested_at", "daily_p_date"),
    "dim_locations": ("location_id", "location_name", "is_active"),
    "fct_daily_api": ("location_id", "dates"),
    "fct_daily_hourly": ("location_id", "dates"),
    "fct_daily": ("location_id", "dates"),
    "fct_daily_quality": ("location_id", "dates"),
}
KEYS = {
    "stg_daily": ("location_id", "dates"),
    "stg_hourly": ("location_id", "observed_at"),
    "hourly_enriched": ("location_id", "observed_at"),
    "daily_enriched": ("location_id", "dates"),
    "fct_daily_api": ("location_id", "dates"),
    "fct_daily_hourly": ("location_id", "dates"),
    "fct_daily": ("location_id", "dates"),
    "fct_daily_quality": ("location_id", "dates"),
}
LABELS = {
    ("fct_daily", "temperature_source"): (HOURLY_SOURCE, FEED_SOURCE),
    ("fct_daily", "precipitation_source"): (HOURLY_SOURCE, FEED_SOURCE),
    ("fct_daily", "sunshine_source"): (FEED_SOURCE,),
    ("fct_daily_quality", "reconciliation_status"): (STATUS_OK, STATUS_WARNING, STATUS_MISSING),
}
NON_NEGATIVE = ">= 0"
HOURS_OF_DAY = "between 0 and 24"
SECONDS_OF_DAY = "between 0 and 86400"
TEMPERATURE_RANGE = "between -80 and 70"
DERIVED_TEMPERATURE_RANGE = "between -80 and 60"
GAP_LIMITS = {
    "diff_temp_max_api_vs_hourly": 8,
    "diff_temp_min_api_vs_hourly": 8,
    "diff_precip_api_vs_hourly": 20,
}


def _plausible_temperature(metric: str) -> str:
    return f"{metric} is not null and {metric} >= -80 and {metric} < 70"


def _absent_or(column: str, rest: str) -> str:
    return f"{column} is null or {column} {rest}"


def _flag_invariant(flag: str, metric: str) -> str:
    return (
        f"({metric} is null and {flag} is null) or ({metric} > 0 and {flag})"
        f" or ({metric} <= 0 and not {flag})"
    )


# Bounds and labels of the bands, stated apart from the code that makes the labels, so that a
# wrong bound there breaks an invariant. Precipitation's first bound belongs to the second band.
BANDS = {
    "temp_bucket": ("temperature_2m", (0, 15, 25), ("freezing", "cold", "mild", "hot")),
    "humidity_bucket": (
        "relative_humidity_2m",
        (30, 50, 60, 70),
        ("dry", "mild", "moderately humid", "humid", "very humid"),
    ),
    "wind_bucket": ("wind_speed_10m", (19, 38, 61), ("light", "moderate", "strong", "gale")),
    "precipitation_bucket": (
        "precipitation",
        (0.1, 2.5, 7.5, 30),
        ("no precipitation", "very light", "light", "moderate", "heavy"),
    ),
}


def _band_invariant(column: str) -> str:
    """Each label goes with exactly the values between its bounds."""
    metric, bounds, labels = BANDS[column]
    cases = [f"({metric} is null and {column} is null)"]
    floor = None
    for position, label in enumerate(labels):
        limits = [] if floor is None else [floor]
        if position < len(bounds):
            is_open = metric == "precipitation" and position == 0
            limits.append(f"{metric} {'<' if is_open else '<='} {bounds[position]}")
            floor = f"{metric} {'>=' if is_open else '>'} {bounds[position]}"
        cases.append("(" + " and ".join([*limits, f"{column} = '{label}'"]) + ")")
    return " or ".join(cases)


def _staging_conditions() -> list[Check]:
    daily = [_plausible_temperature(metric) for metric in TEMPERATURES] + [
        _absent_or(metric, NON_NEGATIVE) for metric in (*SUMS, "sunshine_duration")
    ]
    hourly = [_plausible_temperature("temperature_2m")] + [
        _absent_or(metric, NON_NEGATIVE)
        for metric in (
            "relative_humidity_2m",
            "precipitation",
            "rain",
            "snowfall",
            "snow_depth",
            "wind_speed_10m",
        )
    ]
    return [Check("stg_daily", EXPRESSION, condition=c) for c in daily] + [
        Check("stg_hourly", EXPRESSION, condition=c) for c in hourly
    ]


def _enriched_conditions() -> list[Check]:
    table = "hourly_enriched"
    labels = [
        Check(table, ACCEPTED_VALUES, (column,), values=labels)
        for column, (_, _, labels) in BANDS.items()
    ]
    invariants = [_flag_invariant(flag, metric) for flag, metric in FLAGS.items()] + [
        _band_invariant(column) for column in BANDS
    ]
    return labels + [Check(table, EXPRESSION, condition=c) for c in invariants]


def _column_conditions() -> list[Check]:
    """Conditions that start with their column, per table."""
    absent = {metric: f"is null or {metric} {NON_NEGATIVE}" for metric in SUMS}
    gaps = {gap: f"is null or abs({gap}) <= {limit}" for gap, limit in GAP_LIMITS.items()}

    def each(names, condition: str) -> dict[str, str]:
        return dict.fromkeys(names, condition)

    rules = {
        "daily_enriched": each([f"{metric}_from_hourly" for metric in SUMS], NON_NEGATIVE)
        | each(HOUR_COUNTS, HOURS_OF_DAY)
        | absent
        | {"sunshine_duration": f"is null or sunshine_duration {SECONDS_OF_DAY}"}
        | gaps,
        "fct_daily_api": each(TEMPERATURES, TEMPERATURE_RANGE)
        | each(SUMS, NON_NEGATIVE)
        | {"sunshine_duration": SECONDS_OF_DAY},
        "fct_daily_hourly": each(TEMPERATURES, DERIVED_TEMPERATURE_RANGE)
        | each(SUMS + WINDS, NON_NEGATIVE)
        | each(HOUR_COUNTS, HOURS_OF_DAY),
        "fct_daily": each(TEMPERATURES, TEMPERATURE_RANGE)
        | each(SUMS, NON_NEGATIVE)
        | {"sunshine_duration": SECONDS_OF_DAY}
        | each(HOUR_COUNTS, HOURS_OF_DAY),
        "fct_daily_quality": {"completeness_score": "between 0 and 1"},
    }
    return [
        Check(table, COLUMN_EXPRESSION, (column,), condition)
        for table, conditions in rules.items()
        for column, condition in conditions.items()
    ]


def declared_checks() -> list[Check]:
    checks = [
        Check(table, NOT_NULL, (column,)) for table, cols in REQUIRED.items() for column in cols
    ]
    checks.append(Check("dim_locations", UNIQUE, ("location_id",)))
    checks += [Check(table, UNIQUE_COMBINATION, keys) for table, keys in KEYS.items()]
    checks += [
        Check(table, ACCEPTED_VALUES, (column,), values=values)
        for (table, column), values in LABELS.items()
    ]
    sourced = " or ".join(
        f"{column} is not null"
        for column in ("temperature_source", "precipitation_source", "sunshine_source")
    )
    checks.append(Check("fct_daily", EXPRESSION, condition=sourced))
    return checks + _staging_conditions() + _enriched_conditions() + _column_conditions()
