"""Compare registered queries with their check SQL: ``python tools/check.py [-s SF] [name-part ...]``."""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

from pageloom.plans import catalog
from pageloom.plans.registry import TABLES, with_ctes
from pageloom.session import build_session


def norm(value):
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, (int,)):
        return ("int", value)
    if isinstance(value, float):
        return ("float", None if math.isnan(value) else round(value, 6))
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("time", value.isoformat())
    if isinstance(value, (bytearray, bytes)):
        return ("bytes", bytes(value).hex())
    if isinstance(value, list):
        return ("list", str([norm(v) for v in value]))
    return ("str", value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(norm(r[i]) for i in order) for r in rows), key=repr
    )


def compare(spark, con, entry, sf_dir):
    """Return (ok, text, n_rows, seconds)."""
    start = time.time()
    df = entry.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if entry.oracle is None:
        return len(got) > 0, "rows only", len(got), took
    res = con.execute(with_ctes(entry.oracle))
    names = [d[0] for d in res.description]
    want = res.fetchall()
    a_cols, a = rows_of(df.columns, got)
    b_cols, b = rows_of(names, want)
    if a_cols != b_cols:
        return False, f"columns {a_cols} / {b_cols}", len(got), took
    if a != b:
        only_a = [x for x in a if x not in set(b)][:2]
        only_b = [x for x in b if x not in set(a)][:2]
        return False, f"{len(a)} rows / {len(b)} rows\n  spark only: {only_a}\n  sql only:   {only_b}"[:3000], len(got), took
    return len(got) > 0, "equal" if got else "EMPTY", len(got), took


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("-s", default="0.001")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.s}"
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for entry in catalog.all_queries().values():
        if args.names and not any(n in entry.name or n == entry.survey.rstrip("0123456789") or n == entry.survey for n in args.names):
            continue
        try:
            ok, text, n, took = compare(spark, con, entry, sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, text, n, took = False, f"{type(error).__name__}: {str(error)[:1500]}", 0, 0.0
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {entry.survey:5} {entry.name:32} {n:7d} {took:6.2f}s {text}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
