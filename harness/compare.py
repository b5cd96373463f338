"""Compare registered queries with their SQL on one table folder.

    python -m harness.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from harness.oracle import statements
from harness.queries import registered

DEFAULT_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    database = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return database


def _value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else x + 0.0
    return x


def normalised(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def compare(spark: SparkSession, sf_dir: str, name: str, sql: str | None) -> str:
    """``ok``, ``rows only`` or a description of the first difference."""
    result = registered()[name](spark, sf_dir)
    columns, ours = normalised(result.columns, result.collect())
    if sql is None:
        return f"rows only ({len(ours)})"
    cursor = connect(sf_dir).execute(sql)
    names, theirs = normalised([d[0] for d in cursor.description], cursor.fetchall())
    if columns != names:
        return f"columns differ: {sorted(set(columns) ^ set(names))}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs, strict=True) if repr(a) != repr(b)]
    if not wrong:
        return f"ok ({len(ours)})"
    cells = [(n, x, y) for n, x, y in zip(columns, *wrong[0], strict=True) if repr(x) != repr(y)]
    return f"{len(wrong)} of {len(ours)} rows differ, first: {cells[:4]}"


def main() -> None:
    from ridgeway.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else DEFAULT_DIR
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    sql = statements()
    for name in registered():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            outcome = compare(spark, sf_dir, name, sql.get(name))
        except Exception as error:  # report and go on with the next query
            outcome = f"FAILED {str(error)[:500]}"
        print(f"{name}: {outcome} [{time.time() - started:.1f}s]", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
