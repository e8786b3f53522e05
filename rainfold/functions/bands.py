"""Labels and flags of one hourly reading."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Banding:
    """Ascending upper bounds with their labels, and the label above the last bound.

    Bounds are inclusive, except the first one when ``open_first`` is set.
    """

    metric: str
    bounds: tuple[tuple[float, str], ...]
    above: str
    open_first: bool = False

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(label for _, label in self.bounds) + (self.above,)

    def column(self) -> Column:
        """A null value meets no bound and is not present above them, so its label is null."""
        branches = [
            f"when {self.metric} {'<' if self.open_first and i == 0 else '<='} {bound} "
            f"then '{label}'"
            for i, (bound, label) in enumerate(self.bounds)
        ]
        branches.append(f"when {self.metric} is not null then '{self.above}'")
        return F.expr(f"case {' '.join(branches)} end")


# Band bounds and labels.
BANDINGS = {
    "temp_bucket": Banding(
        "temperature_2m", ((0, "freezing"), (15, "cold"), (25, "mild")), "hot"
    ),
    "humidity_bucket": Banding(
        "relative_humidity_2m",
        ((30, "dry"), (50, "mild"), (60, "moderately humid"), (70, "humid")),
        "very humid",
    ),
    "wind_bucket": Banding(
        "wind_speed_10m", ((19, "light"), (38, "moderate"), (61, "strong")), "gale"
    ),
    "precipitation_bucket": Banding(
        "precipitation",
        ((0.1, "no precipitation"), (2.5, "very light"), (7.5, "light"), (30, "moderate")),
        "heavy",
        open_first=True,
    ),
}

# Flag name and the metric it looks at.
FLAGS = {"is_precipitating": "precipitation", "is_rain": "rain", "is_snowfall": "snowfall"}


def band_columns() -> list[Column]:
    return [banding.column().alias(name) for name, banding in BANDINGS.items()]


def flag_columns() -> list[Column]:
    """Three-valued: a null metric gives a null flag."""
    return [(F.col(metric) > 0).alias(name) for name, metric in FLAGS.items()]
