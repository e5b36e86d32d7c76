"""Run queries and oracles side by side: ``python -m checks.compare SF_DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

from checks.adapters import TABLES
from checks.oracles import oracle_sql
from checks.queries import queries
from evergreen.session import build_session


def plain(v: object) -> object:
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, Decimal)):
        return round(float(v), 12)
    return v if isinstance(v, (int, str)) else str(v)


def rows_of(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, d: str, name: str) -> tuple[bool, str]:
    t0 = time.time()
    df = queries()[name](spark, d)
    got = rows_of(df.columns, df.collect())
    t1 = time.time()
    cur = con.execute(oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    want = rows_of(columns, cur.fetchall())
    t2 = time.time()
    info = f"rows={len(got)} spark={t1 - t0:.2f}s sql={t2 - t1:.2f}s"
    if sorted(df.columns) != sorted(columns):
        return False, f"{info} columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        extra = list(set(got) - set(want))[:3]
        lacking = list(set(want) - set(got))[:3]
        return False, f"{info} want={len(want)}\n  only spark {extra}\n  only sql   {lacking}"
    return True, info


def connect(d: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    return con


def main() -> None:
    d, names = sys.argv[1], sys.argv[2:] or list(queries())
    spark = build_session(f"local[{os.environ.get('BENCH_CPUS', '8')}]", partitions=8)
    spark.sparkContext.setLogLevel("OFF")
    con, bad = connect(d), 0
    for n in names:
        try:
            ok, info = compare(spark, con, d, n)
        except Exception as e:  # noqa: BLE001 - report and go on
            ok, info = False, f"{type(e).__name__} {str(e)[:700]}"
        bad += not ok
        print("ok  " if ok else "FAIL", n, info, flush=True)
    print(f"{len(names) - bad}/{len(names)} match")


if __name__ == "__main__":
    main()
