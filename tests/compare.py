"""Compare registered queries with their SQL: schema, row count, values in any order.

Run as a script: ``python tests/compare.py FOLDER [NAME ...]``.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("lineitem", "orders", "supplier")


def local_session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shotmarts-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checking_engine(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _plain(table: pa.Table) -> pa.Table:
    """Columns by name, with 32-bit offsets for text."""
    table = table.select(sorted(table.column_names))
    kinds = {pa.large_string(): pa.string()}
    fields = [pa.field(f.name, kinds.get(f.type, f.type)) for f in table.schema]
    return table.cast(pa.schema(fields))


def _rows(table: pa.Table) -> list[tuple]:
    rows = zip(*[column.to_pylist() for column in table.columns], strict=True)
    return sorted((tuple(map(repr, row)) for row in rows))


def differences(got: pa.Table, expected: pa.Table) -> str | None:
    """What differs, or None."""
    got, expected = _plain(got), _plain(expected)
    kinds = [(f.name, str(f.type)) for f in got.schema]
    wanted = [(f.name, str(f.type)) for f in expected.schema]
    if kinds != wanted:
        return f"schema: {sorted(set(kinds) ^ set(wanted))}"
    if got.num_rows != expected.num_rows:
        return f"rows: {got.num_rows} instead of {expected.num_rows}"
    left, right = _rows(got), _rows(expected)
    wrong = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    if wrong:
        return f"values: {len(wrong)} rows, first {wrong[0][0]} instead of {wrong[0][1]}"
    return None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as registry

    spark, con = local_session(), checking_engine(folder)
    queries, oracle = registry.queries(), registry.oracle_sql()
    bad = 0
    for name in names or list(queries):
        start = time.time()
        try:
            got = queries[name](spark, folder).toArrow()
            spark_sec, start = time.time() - start, time.time()
            expected = con.execute(oracle[name]).to_arrow_table()
            result = differences(got, expected)
            print(f"{name:24s} {got.num_rows:7d} rows {spark_sec:6.2f}s {time.time() - start:6.2f}s {result or 'ok'}", flush=True)
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:700]}"
            print(f"{name:24s} {result}", flush=True)
        bad += result is not None
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
