"""Runs registered queries next to their SQL in DuckDB and compares the results.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("opsframe")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


# DuckDB type of each Spark type.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def _cell(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _digest(columns: list[str], rows: list[tuple]) -> tuple[int, str, list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_cell(row[i]) for i in order) for row in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> tuple[bool, str]:
    """Whether both sides agree, and what was found."""
    from opsframe.plans.catalogue import ORACLES, QUERIES

    started = time.time()
    result = QUERIES[name](spark, sf_dir)
    rows = [tuple(row) for row in result.collect()]
    took = time.time() - started
    if name not in ORACLES:
        return True, f"{len(rows)} rows, no SQL, {took:.1f}s"
    answer = con.sql(ORACLES[name])
    expected = answer.fetchall()
    if sorted(result.columns) != sorted(answer.columns):
        return False, f"columns {result.columns} / {answer.columns}"
    expected_types = dict(zip(answer.columns, map(str, answer.types)))
    wrong = {c: (kind, expected_types[c]) for c, kind in result.dtypes if TYPES.get(kind) != expected_types[c]}
    if wrong:
        return False, f"types {wrong}"
    n, mine, lines = _digest(result.columns, rows)
    m, theirs, wanted = _digest(answer.columns, expected)
    if mine == theirs and n:
        return True, f"{n} rows, {took:.1f}s"
    extra = sorted(set(lines) - set(wanted))[:3]
    missing = sorted(set(wanted) - set(lines))[:3]
    return False, f"rows {n} / {m}\n  only Spark:  {extra}\n  only DuckDB: {missing}"


def main() -> int:
    from opsframe.plans.catalogue import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    failed = []
    for name in sys.argv[2:] or sorted(QUERIES):
        try:
            good, found = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            good, found = False, "".join(traceback.format_exception_only(error))[:1500]
        print("ok  " if good else "FAIL", name, found, flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    spark.stop()
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
