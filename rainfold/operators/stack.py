"""Frames on top of each other."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def stack_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column a frame lacks is null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
