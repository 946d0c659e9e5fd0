"""Run every registered query next to its SQL counterpart and report differences.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks import oracle, registry
from meterflow.session import apply_settings

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _plain(value):
    return value.item() if hasattr(value, "item") else value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def difference(spark: SparkSession, connection, name: str, sf_dir: str) -> str | None:
    """None if both sides agree, else a short description."""
    df = registry.run(name, spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    if name not in oracle.QUERIES:
        return None if ours else "no rows"
    result = connection.execute(oracle.statement(name))
    columns = [field[0] for field in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(set(columns) ^ set(df.columns))}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sorted(columns)}\n    {a}\n    {b}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.REGISTRY)
    spark = (
        apply_settings(SparkSession.builder.master("local[8]"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_tables(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
