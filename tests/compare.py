"""Run registered queries and their SQL twins side by side.

    python tests/compare.py [scale folder] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same rows; else a short description."""
    result = con.execute(sql)
    want = _rows([c[0] for c in result.description], result.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return None
    extra = [r for r in got[1] if r not in set(want[1])][:2]
    missing = [r for r in want[1] if r not in set(got[1])][:2]
    return f"{len(got[1])} rows != {len(want[1])}; only here {extra}; only SQL {missing}"


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql, failed = oracle_sql(), 0
    for name, fn in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            problem = difference(fn(spark, sf_dir), con, sql[name])
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main())
