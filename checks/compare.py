"""Run queries against their DuckDB twins: ``python -m checks.compare SF_DIR [name-prefix ...]``."""

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks.oracles import SQL
from checks.queries import QUERIES
from ledgerwatch.session import local_session


def cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return f"bool:{value}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def check(spark, con, sf_dir: str, name: str) -> tuple[str, float]:
    start = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    seconds = time.perf_counter() - start
    if name not in SQL:
        return f"rows only ({len(rows)})" if rows else "EMPTY", seconds
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    want, want_names = bag(names, cursor.fetchall())
    got, got_names = bag(df.columns, rows)
    if got_names != want_names:
        return f"COLUMNS {got_names} != {want_names}", seconds
    if got != want:
        extra, lost = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"VALUES got {sum(got.values())} want {sum(want.values())}: +{extra} -{lost}", seconds
    return f"equal ({len(rows)})", seconds


def main() -> None:
    sf_dir, prefixes = sys.argv[1], sys.argv[2:]
    spark, con = local_session("compare"), oracle_connection(sf_dir)
    bad = 0
    for name in QUERIES:
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            verdict, seconds = check(spark, con, sf_dir, name)
        except Exception as error:
            verdict, seconds = f"ERROR {type(error).__name__}: {str(error)[:600]}", 0.0
        bad += not verdict.startswith(("equal", "rows only"))
        print(f"{name:36} {seconds:7.2f}s  {verdict}", flush=True)
    print(f"{bad} bad; oracles without a query: {sorted(set(SQL) - set(QUERIES))}")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
