"""Run registered queries next to their oracles: python tests/oracle_check.py DIR [key ...]"""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE"}


def cell(value):
    """A value in a form both engines agree on."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, Decimal)):
        value = float(value)
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)[:10] if not isinstance(value, dt.datetime) else str(value)
    return repr(str(value))


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(cell(r[i]) for i in order) for r in rows])


def connect(sf_dir):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return con


def compare(spark, con, sf_dir, run, sql):
    """Differences between a query and its oracle, empty when there are none."""
    df = run(spark, sf_dir)
    spark_rows = df.collect()
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    sql_rows = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {c[0]: str(c[1]) for c in result.description}
    odd = {n: (t, types[n]) for n, t in df.dtypes if TYPES[t] != types[n]}
    if odd:
        return f"types differ: {odd}"
    ours, theirs = normal(spark_rows, df.columns), normal(sql_rows, names)
    if ours != theirs:
        only_ours = [r for r in ours if r not in set(theirs)][:2]
        only_theirs = [r for r in theirs if r not in set(ours)][:2]
        return f"rows {len(ours)} vs {len(theirs)}; spark only {only_ours}; oracle only {only_theirs}"
    if not ours:
        return "no rows"
    return ""


if __name__ == "__main__":
    from conftest import session

    import __spark_entry__ as entry

    sf_dir, keys = sys.argv[1], sys.argv[2:]
    spark, con = session(), connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for key, run in entry.queries().items():
        if keys and key not in keys:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, run, oracles[key])
        except Exception as failure:
            problem = f"{type(failure).__name__}: {str(failure)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {key} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} failing")
