"""Checks that stop a job before it does wrong work."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class KeyConflict(ValueError):
    """Rows would break the uniqueness of a table key."""


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> DataFrame:
    """Schema only, no job."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks columns: {missing}")
    return df


def repeated_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Key combinations held by more than one row, with their row count ``n``.

    Counts combine before the shuffle, so a key shared by very many rows costs one row per task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: Iterable[str], what: str) -> DataFrame:
    """Keys with a null part never conflict, as in a relational unique index."""
    keys = list(keys)
    clash = repeated_keys(df.dropna(subset=keys), keys).first()
    if clash is not None:
        raise KeyConflict(f"{what}: key {clash.asDict()} is not unique")
    return df
