"""Run registered queries next to their SQL oracles and compare results.

    python tests/oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from pledgeflow.queries import all_oracles, all_queries  # noqa: E402
from pledgeflow.session import get_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return ("null", "")
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        if math.isnan(value):
            return ("float", "nan")
        return ("float", float(f"{value:.10g}"))
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("list", tuple(_cell(v) for v in value))
    if isinstance(value, dict):
        return ("map", tuple(sorted((k, _cell(v)) for k, v in value.items())))
    return ("str", str(value))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark_df, con, sql) -> str | None:
    """None when equal, else a short description of the first difference."""
    got_cols, got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = canonical([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        only_got = [r for r in got[:2000] if r not in set(want)][:2]
        only_want = [r for r in want[:2000] if r not in set(got)][:2]
        return f"rows {len(got)} != {len(want)}: spark only {only_got}; oracle only {only_want}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None if got else "empty result"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = get_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                              "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    queries, oracles = all_queries(), all_oracles()
    names = [n for n in queries if not args.names or any(n.startswith(p) for p in args.names)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, args.sf)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                problem = None if df.count() else "empty result"
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += problem is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {kind:4s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
