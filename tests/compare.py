"""Run registered queries next to their SQL checks and report differences."""

from __future__ import annotations

import math
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

from pactum.sources import adapter


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in adapter.BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 9) + 0.0)
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return repr(float(value))
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(normal(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def check_rows(con, sql):
    cursor = con.execute(sql)
    return sorted_rows([d[0] for d in cursor.description], cursor.fetchall())


if __name__ == "__main__":
    import __spark_entry__ as entry
    from pactum.session import build_session

    sf_dir = "/root/testdata/sf0.01"
    patterns = sys.argv[1:]
    if patterns and patterns[0].startswith("/"):
        sf_dir = patterns.pop(0)
    spark, con = build_session("compare", 8), connect(sf_dir)
    checks = entry.oracle_sql()
    bad = []
    for name, build in entry.queries().items():
        if patterns and not any(re.fullmatch(p, name) for p in patterns):
            continue
        try:
            started = time.time()
            columns, rows = spark_rows(build(spark, sf_dir))
            took = time.time() - started
            if name not in checks:
                print(f"{name:32s} rows={len(rows)} {took:.2f}s (no check)", flush=True)
                continue
            started = time.time()
            want_columns, want = check_rows(con, checks[name])
            same = columns == want_columns and rows == want
            print(f"{name:32s} rows={len(rows)}/{len(want)} {'ok' if same else 'DIFF'} "
                  f"{took:.2f}s check {time.time() - started:.2f}s", flush=True)
            if not same:
                bad.append(name)
                print("   spark", columns, "\n   check", want_columns)
                extra, lost = sorted(set(rows) - set(want))[:2], sorted(set(want) - set(rows))[:2]
                print("   only spark:", extra, "\n   only check:", lost)
        except Exception as exc:
            bad.append(name)
            print(f"{name:32s} ERROR {type(exc).__name__} {str(exc)[:1500]}", flush=True)
    print("failed:", bad)
