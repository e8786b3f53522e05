"""Data checks: a check is a query that should return no rows."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rainfold.operators.guards import repeated_keys

# Check kinds.
NOT_NULL = "not_null"
UNIQUE = "unique"
UNIQUE_COMBINATION = "unique_combination"
ACCEPTED_VALUES = "accepted_values"
EXPRESSION = "expression"
COLUMN_EXPRESSION = "column_expression"


def _quoted(text: str) -> str:
    """Text as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True)
class Check:
    """A declared check on one table.

    ``condition`` is SQL text that must not be false; a null outcome passes. For a column
    expression it is the part that follows the column name.
    """

    table: str
    kind: str
    columns: tuple[str, ...] = ()
    condition: str | None = None
    values: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        detail = {
            ACCEPTED_VALUES: "|".join(self.values),
            EXPRESSION: self.condition,
            COLUMN_EXPRESSION: self.condition,
        }.get(self.kind)
        return " ".join([self.kind, *(["+".join(self.columns)] if self.columns else []),
                         *([detail] if detail else [])])

    @property
    def counts_keys(self) -> bool:
        return self.kind in (UNIQUE, UNIQUE_COMBINATION)

    @property
    def violated(self) -> str:
        """SQL that is true on failing rows. Only for checks that look at one row at a time."""
        if self.kind == NOT_NULL:
            return f"{self.columns[0]} is null"
        if self.kind == ACCEPTED_VALUES:
            return f"{self.columns[0]} not in ({', '.join(map(_quoted, self.values))})"
        if self.kind == EXPRESSION:
            return f"not ({self.condition})"
        if self.kind == COLUMN_EXPRESSION:
            return f"not ({self.columns[0]} {self.condition})"
        raise ValueError(f"{self.kind} is not a row check")

    def failing(self, df: DataFrame) -> DataFrame:
        """Failing rows, or repeated keys with their row count."""
        if not self.counts_keys:
            return df.where(self.violated)
        # A null in a single unique column never counts as a repeat; in a combination it does.
        rows = df.dropna(subset=list(self.columns)) if self.kind == UNIQUE else df
        return repeated_keys(rows, self.columns)


def run_checks(tables: dict[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check: ``table``, ``check``, ``failures`` and ``status``.

    All row checks of a table share one aggregate over one scan; each key check is one grouped
    count. Nothing is collected: the report is a DataFrame.
    """
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        by_table.setdefault(check.table, []).append(check)
    reports = []
    for table, declared in by_table.items():
        df = tables[table]
        row_checks = [check for check in declared if not check.counts_keys]
        if row_checks:
            reports.append(_row_report(df, table, row_checks))
        for check in declared:
            if check.counts_keys:
                reports.append(
                    check.failing(df).selectExpr(
                        f"{_quoted(table)} as `table`",
                        f"{_quoted(check.name)} as `check`",
                        "count(*) as failures",
                    )
                )
    report = reduce(DataFrame.unionByName, reports)
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def _row_report(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    counts = df.selectExpr(
        *[f"count_if({check.violated}) as n{i}" for i, check in enumerate(checks)]
    )
    entries = ", ".join(f"{_quoted(check.name)}, n{i}" for i, check in enumerate(checks))
    return counts.selectExpr(
        f"{_quoted(table)} as `table`", f"stack({len(checks)}, {entries}) as (`check`, failures)"
    )


def failures_by_date(rows: DataFrame, partition: str, checks: Iterable[Check]) -> DataFrame:
    """Failures of each check on each date: ``table``, ``check``, ``failures`` and the date.

    Sums over dates are the failures of the whole table, for checks that look at one row and for keys
    that lie in one date. All row checks share one aggregate over one scan, whatever table they are
    declared on.
    """
    checks = list(checks)
    row_checks = [check for check in checks if not check.counts_keys]
    found = []
    if row_checks:
        counts = rows.groupBy(partition).agg(
            *[F.expr(f"count_if({check.violated})").alias(f"n{i}") for i, check in enumerate(row_checks)]
        )
        entries = ", ".join(
            f"{_quoted(check.table)}, {_quoted(check.name)}, n{i}"
            for i, check in enumerate(row_checks)
        )
        stacked = f"stack({len(row_checks)}, {entries}) as (`table`, `check`, failures)"
        found.append(counts.selectExpr(stacked, partition))
    # Tables that are checked on the same rows have their keys counted once.
    by_key: dict[tuple, list[Check]] = {}
    for check in checks:
        if check.counts_keys:
            by_key.setdefault((check.kind, check.columns), []).append(check)
    for (kind, columns), same in by_key.items():
        kept = rows.dropna(subset=list(columns)) if kind == UNIQUE else rows
        keys = dict.fromkeys([partition, *columns])
        repeats = repeated_keys(kept, keys).groupBy(partition).agg(F.count("*").alias("failures"))
        entries = ", ".join(f"{_quoted(check.table)}, {_quoted(check.name)}" for check in same)
        stacked = f"stack({len(same)}, {entries}) as (`table`, `check`)"
        found.append(repeats.selectExpr(stacked, "failures", partition))
    return reduce(DataFrame.unionByName, found)


def report_of(spark: SparkSession, states: Iterable[DataFrame], checks: Iterable[Check]) -> DataFrame:
    """The report of ``run_checks`` from stored failures by date."""
    declared = spark.createDataFrame(
        [(check.table, check.name, 0) for check in checks], "`table` string, `check` string, failures long"
    )
    parts = [state.select("table", "check", "failures") for state in states]
    report = (
        reduce(DataFrame.unionByName, [declared, *parts])
        .groupBy("table", "check")
        .agg(F.sum("failures").alias("failures"))
    )
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


# Ages at which a source counts as stale.
WARN_AFTER = timedelta(days=7)
ERROR_AFTER = timedelta(days=30)


def freshness(sources: dict[str, DataFrame], now: datetime) -> DataFrame:
    """One row per source: newest ``ingested_at`` and pass, warn or error by its age at ``now``.

    ``now`` is UTC. A source without rows is an error.
    """
    now = now.astimezone(timezone.utc).replace(tzinfo=None) if now.tzinfo else now

    def limit(age: timedelta) -> Column:
        return F.lit((now - age).isoformat(sep=" ")).cast("timestamp_ntz")

    def one(name: str, df: DataFrame) -> DataFrame:
        newest = F.col("max_loaded_at")
        return df.agg(F.max("ingested_at").alias("max_loaded_at")).select(
            F.lit(name).alias("source"),
            newest,
            F.when(newest >= limit(WARN_AFTER), "pass")
            .when(newest >= limit(ERROR_AFTER), "warn")
            .otherwise("error")
            .alias("status"),
        )

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in sources.items()])
