"""Compare registered queries with their SQL counterparts.

``python tests/oracle_check.py [names]``; CHECK_SF_DIR picks the tables, and CHECK_LIMIT
makes every group above that many rows take the branch for heavy groups.
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def _plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if hasattr(value, "as_tuple"):
        value = float(value) if value != value.to_integral_value() else int(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _key(row):
    return tuple((v is None, type(v).__name__ if not isinstance(v, (int, float)) else "n", v if v is not None else 0) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=_key)


def duck(folder):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return rows_of(columns, cursor.fetchall())


def spark_rows(frame):
    return rows_of(frame.columns, [tuple(r) for r in frame.collect()])


def difference(got, want):
    """None when equal, else a short text."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for ours, theirs in zip(got[1], want[1]):
        if ours != theirs:
            cells = [(c, a, b) for c, a, b in zip(got[0], ours, theirs) if a != b]
            return f"first difference {cells[:4]} in {ours}"
    return None


def main(names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if "CHECK_LIMIT" in os.environ:
        for field in ("max_group_rows", "max_fold_rows"):
            spark.conf.set(f"spark.tidewire.{field}", os.environ["CHECK_LIMIT"])
    connection = duck(folder)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failed = []
    for name in names or queries:
        began = time.time()
        try:
            got = spark_rows(queries[name](spark, folder))
            ours = time.time() - began
            if name in oracles:
                began = time.time()
                problem = difference(got, duck_rows(connection, oracles[name]))
                theirs = time.time() - began
            else:
                problem, theirs = None, 0
        except Exception as error:
            problem, ours, theirs, got = f"{type(error).__name__}: {str(error)[:600]}", 0, 0, ([], [])
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok':4} {name:32} {len(got[1]):7} {ours:6.2f}s {theirs:6.2f}s {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
