"""Run registered queries against their DuckDB oracles.

usage: python tools/check.py <folder> [name-prefix ...]
"""

import importlib
import math
import os
import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/", 2)[0])

import duckdb  # noqa: E402

from auditflow import queries as Q  # noqa: E402
from auditflow.fixtures import TABLES  # noqa: E402
from auditflow.session import local_session  # noqa: E402


def norm(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.6g}" if value != int(value) or abs(value) > 1e15 else str(int(value))
    return str(value)


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def compare(spark, con, name, folder):
    started = time.time()
    df = Q._QUERIES[name](spark, folder)
    rows = df.collect()
    took = time.time() - started
    got_cols = sorted(df.columns)
    sql = Q._ORACLES.get(name)
    if sql is None:
        return True, f"rows-only {len(rows)}", took
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != got_cols:
        return False, f"columns {got_cols} != {sorted(names)}", took
    if len(want) != len(rows):
        return False, f"rows spark {len(rows)} duckdb {len(want)}", took
    index = [names.index(c) for c in got_cols]
    a = sorted(tuple(norm(r[c]) for c in got_cols) for r in rows)
    b = sorted(tuple(norm(r[i]) for i in index) for r in want)
    for x, y in zip(a, b):
        if x != y:
            return False, f"values {got_cols}\n    spark  {str(x)[:600]}\n    duckdb {str(y)[:600]}", took
    return True, f"ok {len(rows)}", took


def main():
    folder, prefixes = sys.argv[1], sys.argv[2:]
    spark = local_session()
    if os.environ.get("HOT_ROWS"):
        spark.conf.set("spark.auditflow.hotRows", os.environ["HOT_ROWS"])
    con = connect(folder)
    for family in Q.FAMILIES:
        try:
            importlib.import_module(f"auditflow.queries.{family}")
        except ModuleNotFoundError as error:
            if "auditflow.queries" not in str(error):
                raise
    bad = 0
    for name in Q._QUERIES:
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            good, text, took = compare(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001
            good, text, took = False, "".join(traceback.format_exception_only(error))[:700], 0
        bad += not good
        print(f"{'PASS' if good else 'FAIL'} {name} {took:.2f}s {text}", flush=True)
    print("failures", bad)


if __name__ == "__main__":
    main()
