"""Run queries next to their SQL: ``python tools/check.py [sf] [name ...]`` (prefix* ok)."""

from __future__ import annotations

import fnmatch
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickloom.plans import REGISTRY  # noqa: E402
from tickloom.session import builder  # noqa: E402


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return str(v)


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    pats = sys.argv[2:] or ["*"]
    sf_dir = f"/root/testdata/sf{sf}"
    names = [n for n in REGISTRY if any(fnmatch.fnmatch(n, p) for p in pats)]
    spark = (
        builder("check")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    bad = []
    for n in names:
        q = REGISTRY[n]
        t0 = time.time()
        try:
            df = q.build(spark, sf_dir)
            cols = sorted(df.columns)
            rows = df.select(*[f"`{c}`" for c in cols]).collect()
        except Exception as e:  # noqa: BLE001
            bad.append(n)
            print(f"FAIL {n}: spark {str(e)[:600]}", flush=True)
            continue
        t1 = time.time()
        if q.sql is None:
            print(f"rows {n}: {len(rows)} {t1 - t0:.1f}s", flush=True)
            if not rows:
                bad.append(n)
                print(f"EMPTY {n}")
            continue
        try:
            cur = con.execute(q.sql)
            names_sql = [d[0] for d in cur.description]
            want = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            bad.append(n)
            print(f"FAIL {n}: sql {str(e)[:900]}", flush=True)
            continue
        t2 = time.time()
        if sorted(names_sql) != cols:
            bad.append(n)
            print(f"FAIL {n}: columns {cols} vs {sorted(names_sql)}")
            continue
        order = [names_sql.index(c) for c in cols]
        a = sorted(tuple(norm(x) for x in row) for row in rows)
        b = sorted(tuple(norm(row[i]) for i in order) for row in want)
        note = "" if rows else " EMPTY"
        if a == b:
            print(f"ok   {n}: {len(a)}{note} spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s", flush=True)
            if not rows:
                bad.append(n)
        else:
            bad.append(n)
            diff = [(x, y) for x, y in zip(a, b) if x != y]
            print(f"FAIL {n}: {len(a)} vs {len(b)} rows, {len(diff)} differ; {cols}", flush=True)
            for x, y in diff[:3]:
                print("   spark", x)
                print("   sql  ", y)
    print(f"{len(names) - len(bad)} of {len(names)} ok; bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
