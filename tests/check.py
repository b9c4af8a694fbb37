"""Compare registered queries with their SQL: `python tests/check.py [sf] [name ...]`."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(round(value, 6))
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def compare(spark, con, name, query, sql, sf_dir):
    started = time.time()
    df = query(spark, sf_dir)
    rows = df.collect()
    took = time.time() - started
    if sql is None:
        return f"rows only ({len(rows)})", took
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = table_of(names, result.fetchall())
    got = table_of(df.columns, rows)
    if got == want:
        return f"ok ({len(rows)})", took
    if got[0] != want[0]:
        return f"COLUMNS {got[0]} != {want[0]}", took
    extra = [r for r in got[1] if r not in set(want[1])]
    missing = [r for r in want[1] if r not in set(got[1])]
    return (
        f"DIFFERENT spark={len(got[1])} sql={len(want[1])}\n   columns {got[0]}"
        f"\n   only spark {[tuple(c[:160] for c in r) for r in extra[:3]]}"
        f"\n   only sql   {[tuple(c[:160] for c in r) for r in missing[:3]]}",
        took,
    )


def main(argv):
    import __spark_entry__ as entry
    from feedloom.session import local_session

    sf = argv[0] if argv else "sf0.01"
    sf_dir = f"{TESTDATA}/{sf}"
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not argv[1:] or n in argv[1:]]
    spark, con = local_session("8"), connect(sf_dir)
    bad = 0
    for name in names:
        print(f"== {name}", file=sys.stderr, flush=True)
        try:
            verdict, took = compare(spark, con, name, queries[name], oracle.get(name), sf_dir)
        except Exception as exc:  # noqa: BLE001
            verdict, took = f"ERROR {str(exc)[:900]}", 0.0
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{name:28s} {took:6.2f}s {verdict}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
