"""Compare every registered query with its DuckDB statement.

``python tests/oracle_compare.py [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in data)


# DuckDB type to the Spark types that hold the same values.
TYPES = {
    "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "DATE": "date", "DOUBLE": "double",
    "BIGINT": "bigint", "INTEGER": "int", "BOOLEAN": "boolean",
}


def compare(spark, connection, sf_dir, query, sql) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(row) for row in df.collect()])
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    wanted = rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {column[0]: TYPES.get(str(column[1]), str(column[1])) for column in result.description}
    types = dict(df.dtypes)
    odd = {name: (types[name], kinds[name]) for name in names if types[name] != kinds[name]}
    if odd:
        return f"types {odd}"
    if got != wanted:
        extra, lacking = got - wanted, wanted - got
        return (
            f"{sum(got.values())} rows, wanted {sum(wanted.values())}; "
            f"extra {list(extra)[:2]} lacking {list(lacking)[:2]}"
        )
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, statements, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            problem = compare(spark, connection, sf_dir, query, statements[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{time.time() - started:6.2f}s {name}: {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
