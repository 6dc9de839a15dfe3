"""Runs named queries on Spark and their SQL on DuckDB and compares whole results."""

from __future__ import annotations

import math
import time


def normal(value):
    import datetime
    import numpy as np

    if value is None:
        return None
    if isinstance(value, (np.generic,)):
        value = value.item()
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def sort_key(row):
    return tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in row)


def compare(spark_df, oracle_columns, oracle_rows):
    names = sorted(spark_df.columns)
    assert names == sorted(oracle_columns), (names, sorted(oracle_columns))
    order = [oracle_columns.index(n) for n in names]
    left = sorted((tuple(normal(v) for v in r) for r in spark_df.select(*[f"`{n}`" for n in names]).collect()), key=sort_key)
    right = sorted((tuple(normal(r[i]) for i in order) for r in oracle_rows), key=sort_key)
    assert len(left) == len(right), (len(left), len(right))
    for a, b in zip(left, right):
        assert a == b, (names, a, b)
    return len(left)


def duck(sf_dir):
    import glob
    import os

    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def run(con, sql):
    cursor = con.execute(sql)
    return [c[0] for c in cursor.description], [c[1] for c in cursor.description], cursor.fetchall()


if __name__ == "__main__":
    import sys
    import traceback

    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from eddyline.session import build_session

    sf = sys.argv[1]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    oracle = entry.oracle_sql()
    bad = []
    for name, build in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            df = build(spark, sf)
            if name in oracle:
                columns, types, rows = run(con, oracle[name])
                mid = time.time()
                n = compare(df, columns, rows)
                kinds = {c: t for c, t in df.dtypes}
                print(f"ok   {name:28s} {n:8d} rows {time.time() - began:6.2f}s (sql {0:.2f})", {c: (kinds[c], str(t)) for c, t in zip(columns, types) if {'bigint': 'BIGINT', 'int': 'INTEGER', 'double': 'DOUBLE', 'string': 'VARCHAR', 'boolean': 'BOOLEAN', 'timestamp_ntz': 'TIMESTAMP'}.get(kinds[c]) != str(t)} or "", flush=True)
            else:
                print(f"rows {name:28s} {df.count():8d} rows {time.time() - began:6.2f}s", flush=True)
        except Exception as e:
            bad.append(name)
            print(f"FAIL {name}: {str(e)[:900]}", flush=True)
            if not isinstance(e, AssertionError) and len(sys.argv) > 2:
                traceback.print_exc()
    print("failed:", bad)
