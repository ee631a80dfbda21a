"""Run registered queries on Spark and their oracles on DuckDB and compare.

    python tests/check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from registry import ORACLES, QUERIES
from registry.fixtures import TABLES

_KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
    "float": "FLOAT", "timestamp": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return ("num", str(v.normalize() if v else decimal.Decimal(0)))
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("flt", repr(v + 0.0))
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, bytes):
        return ("b", v)
    return ("", str(v))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, sf_dir):
    """None when equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return None if got else "no rows"
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    types = dict((c[0], str(c[1])) for c in cur.description)
    odd = {
        c: (t, types[c]) for c, t in df.dtypes
        if not t.startswith(("array", "struct")) and _KINDS.get(t, t.upper()) != types[c]
    }
    if odd:
        return f"types {odd}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ: {bad[0]}"
    return None if got else "no rows"


def main():
    from millrace.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    prefixes = tuple(sys.argv[2:])
    spark = get_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in QUERIES:
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.2f}s{'' if name in ORACLES else ' (rows only)'} {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
