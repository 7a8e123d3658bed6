"""Compare registered queries with their SQL in DuckDB.

As a script: ``python tests/compare.py [folder] [query ...]``.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()


def session(cores: str = "8", partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def difference(run, sql: str, spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    df = run(spark, folder)
    found = _rows(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    if found == expected:
        return None
    surplus, missing = found - expected, expected - found
    return (
        f"{sum(found.values())} rows, expected {sum(expected.values())}; columns {sorted(names)}; "
        f"surplus {sum(surplus.values())} {list(surplus)[:2]}; missing {sum(missing.values())} {list(missing)[:2]}"
    )


def main() -> None:
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark, con = session(), database(folder)
    failed = []
    for name in names:
        began = time.time()
        try:
            if name in oracle:
                problem = difference(queries[name], oracle[name], spark, con, folder)
            else:
                problem = None if queries[name](spark, folder).count() >= 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")


if __name__ == "__main__":
    main()
