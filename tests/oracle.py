"""Run a registered query and its SQL side by side and compare every value."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb  # only here: tests are collected where it is not installed, too

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    """Empty string when equal, else a description of the first difference."""
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if got else "no rows"
    res = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; e.g. {got[:2]} / {want[:2]}"
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"{got_cols}: {a} != {b}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from riskweave.session import build_session

    sf = sys.argv[1]
    pick = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(f"/root/testdata/{sf}")
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if pick and not any(name.startswith(p) for p in pick):
            continue
        start = time.time()
        try:
            msg = compare(spark, con, name, fn, sqls.get(name), f"/root/testdata/{sf}")
        except Exception as e:  # noqa: BLE001
            msg = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(msg)
        print(f"{'ok  ' if not msg else 'FAIL'} {'D' if name in sqls else 'R'} {name} {time.time() - start:.2f}s {msg}", flush=True)
    print("failures:", bad)
