"""Compare registered queries with their SQL on one folder of tables.

    python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return ("nan",) if math.isnan(value) else value + 0.0
        return value

    fixed = [tuple(cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(fixed, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


def main(argv: list[str]) -> None:
    import __spark_entry__ as contract

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, query in contract.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            got = spark_rows(query(spark, folder))
            took = time.time() - start
            sql = contract.oracle_sql().get(name)
            if sql is None:
                print(f"rows {name} {len(got[1])} {took:.2f}s {got[1][:2]}")
                continue
            want = sql_rows(con, sql)
            same = got == want
            failed += not same
            print(f"{'ok  ' if same else 'DIFF'} {name} {len(got[1])} {took:.2f}s")
            if not same:
                print("   columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
                extra = [r for r in got[1] if r not in set(want[1])][:3] if len(got[1]) < 50000 else []
                print("   spark", extra or got[1][:3])
                lack = [r for r in want[1] if r not in set(got[1])][:3] if len(got[1]) < 50000 else []
                print("   sql  ", lack or want[1][:3])
        except Exception as problem:
            failed += 1
            print(f"FAIL {name} {type(problem).__name__}: {str(problem)[:600]}")
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
