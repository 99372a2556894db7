"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, decimal.Decimal):
        return plain(float(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def compare(spark, con, fn, sql, folder):
    df = fn(spark, folder)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got), None
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} <> {sorted(names)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3] if len(got) < 200000 else []
        missing = [r for r in want if r not in set(got)][:3] if len(want) < 200000 else []
        return len(got), f"{len(got)} rows <> {len(want)}; spark only {extra}; sql only {missing}"
    return len(got), None


if __name__ == "__main__":
    import sys
    import time
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from dayfolio.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(8)
    con = connect(folder)
    sql = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            n, problem = compare(spark, con, fn, sql.get(name), folder)
        except Exception as error:  # noqa: BLE001
            n, problem = -1, str(error)[:1500]
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={n} {time.time() - start:.1f}s {'' if name in sql else '(rows only)'} {problem or ''}", flush=True)
    print("failed:", bad)
