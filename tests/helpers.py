"""Small frames in the shape of the real tables."""

from __future__ import annotations

from datetime import date, datetime

from rainfold.schemas import DAILY, HOURLY


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def hourly_rows(spark, *rows: dict):
    """Bronze hourly rows; absent metrics are null and p_date follows observed_at."""
    return _rows(spark, HOURLY, rows)


def daily_rows(spark, *rows: dict):
    return _rows(spark, DAILY, rows)


def _rows(spark, kind, rows):
    def values(row):
        row = {"location_id": "a", "ingested_at": "2024-02-01T00:00:00"} | row
        time = ts(row[kind.time_column])
        filled = {
            "location_id": row["location_id"],
            kind.time_column: time,
            "ingested_at": ts(row["ingested_at"]),
            "p_date": date(time.year, time.month, time.day) if time else None,
        } | {metric: row.get(metric) for metric in kind.metrics}
        return tuple(filled[name] for name in kind.schema.fieldNames())

    return spark.createDataFrame([values(row) for row in rows], kind.schema)


def records(df, *columns) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)
