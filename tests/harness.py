"""Run a query in Spark and its statement in DuckDB and compare the results as multisets."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value, digits: int | None):
    if isinstance(value, float):
        value = 0.0 if value == 0 else value
        return value if digits is None else float(f"{value:.{digits}g}")
    return value


def rows(table, columns: list[str], digits: int | None = None) -> Counter:
    data = table.select(columns).to_pydict()
    return Counter(zip(*([_cell(v, digits) for v in data[c]] for c in columns)))


def compare(spark_table, duck_table, digits: int | None = None) -> list[str]:
    """Differences in words; empty when columns, types and values agree."""
    problems = []
    columns = sorted(spark_table.column_names)
    if columns != sorted(duck_table.column_names):
        return [f"columns {columns} against {sorted(duck_table.column_names)}"]
    for c in columns:
        left, right = spark_table.schema.field(c).type, duck_table.schema.field(c).type
        if str(left).replace("large_", "") != str(right).replace("large_", ""):
            problems.append(f"type of {c}: {left} against {right}")
    left, right = rows(spark_table, columns, digits), rows(duck_table, columns, digits)
    only_left, only_right = left - right, right - left
    if only_left or only_right:
        sample = [str(dict(zip(columns, r)))[:600] for side in (only_left, only_right) for r in sorted(side, key=str)[:2]]
        problems.append(f"rows: {sum(left.values())} against {sum(right.values())}, "
                        f"{sum(only_left.values())} only Spark, {sum(only_right.values())} only DuckDB: {sample}")
    return problems
