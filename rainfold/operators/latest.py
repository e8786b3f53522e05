"""Newest row per key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANK = "_rank"


def latest_by_key(
    df: DataFrame,
    keys: Iterable[str],
    newest_first: Iterable[str] = ("ingested_at", "p_date"),
    within: Iterable[str] = (),
) -> DataFrame:
    """Keep one row per key: the newest by ``newest_first``, where a null counts as newest.

    Order columns the frame does not have are skipped. A hash of the row settles ties, so a
    rerun returns the same rows. Spark plans rank-one filters as a group limit on both sides of
    the shuffle: each task passes on one row per key, however many copies a key has. ``within`` names
    functions of the key that rows are already partitioned by.
    """
    keys = list(keys)
    order = [f"`{name}` desc nulls first" for name in newest_first if name in df.columns]
    order.append(f"xxhash64({_listed([c for c in df.columns if c not in keys] or keys)})")
    rank = f"row_number() over (partition by {_listed([*within, *keys])} order by {', '.join(order)})"
    return df.selectExpr("*", f"{rank} as {_RANK}").where(f"{_RANK} = 1").drop(_RANK)


def latest_of_loaded(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``latest_by_key`` for rows of a table that loads made.

    They hold each key once, but for keys with a null part: these never match, so each load may have
    added one. Only such rows are shuffled.
    """
    keys = list(keys)
    whole = " and ".join(f"`{name}` is not null" for name in keys)
    return df.where(whole).unionAll(latest_by_key(df.where(f"not ({whole})"), keys))


def _listed(names: Iterable[str]) -> str:
    return ", ".join(f"`{name}`" for name in names)


def duplicate_count(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """One row: rows read, rows left by a dedup on ``keys``, and their difference.

    Counting per key needs no row payload in the shuffle, unlike counting the dedup's output.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"),
        F.count(F.lit(1)).alias("rows_kept"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )
