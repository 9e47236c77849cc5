"""Run registered queries in Spark and their SQL in DuckDB, and compare rows.

``python tests/compare.py DIR [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from codeloom.catalog.registry import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return connection


def canonical(value):
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        if math.isnan(value):
            return ("nan",)
        return ("n", round(value, 6) + 0.0)
    if isinstance(value, int):
        return ("n", float(value))
    return ("s", str(value))


def table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows), [names[i] for i in order]


def difference(spark_df, connection, sql: str) -> str | None:
    """None when both sides hold the same rows, else what differs."""
    left, left_names = table([tuple(r) for r in spark_df.collect()], spark_df.columns)
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    right, right_names = table(cursor.fetchall(), names)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        only_l = sorted(set(left) - set(right))[:2]
        only_r = sorted(set(right) - set(left))[:2]
        return f"rows {len(left)} != {len(right)}\n   spark only {only_l}\n   sql only   {only_r}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        only_l = sorted(set(left) - set(right))[:3]
        only_r = sorted(set(right) - set(left))[:3]
        return f"{len(bad)} rows differ of {len(left)}\n   spark only {only_l}\n   sql only   {only_r}"
    return None


def main() -> None:
    import __spark_entry__ as driver
    from codeloom.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    runs, sqls = driver.queries(), driver.oracle_sql()
    failures = 0
    for name in wanted or runs:
        start = time.time()
        try:
            df = runs[name](spark, folder)
            if name in sqls:
                problem = difference(df, connection, sqls[name])
            else:
                rows = df.collect()
                problem = None if rows else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {'' if name in sqls else '(rows only) '}{problem or ''}", flush=True)
    print(f"{failures} failures")


if __name__ == "__main__":
    main()
