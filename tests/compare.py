"""Run registered queries next to their SQL twins: ``python tests/compare.py [folder] [name-prefix ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (int(v) if v == int(v) and abs(v) < 1e15 else v) if math.isfinite(v) else v
    if hasattr(v, "as_tuple"):
        return plain(float(v))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, folder, name, fn, sql):
    start = time.time()
    df = fn(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if sql is None:
        return "rows", len(got[1]), took, ""
    rel = con.execute(sql)
    want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return "COLUMNS", len(got[1]), took, f"{got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return "COUNT", len(got[1]), took, f"{len(got[1])} != {len(want[1])}\n  got  {got[1][:2]}\n  want {want[1][:2]}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        return "VALUES", len(got[1]), took, f"{len(bad)} differ\n  got  {bad[0][0]}\n  want {bad[0][1]}"
    return "ok", len(got[1]), took, ""


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tissuegrid.runtime import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    twins = oracle_sql()
    for name, fn in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            status, n, took, note = compare(spark, con, folder, name, fn, twins.get(name))
        except Exception as error:  # report and go on
            status, n, took, note = "ERROR", 0, 0.0, str(error)[:700]
        print(f"{status:8s} {name:40s} rows={n:<7d} {took:6.2f}s {note}", flush=True)
