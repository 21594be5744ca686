"""Run registered Spark queries and their DuckDB oracle SQL side by side and compare.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_value(v):
    if v is None or (not isinstance(v, (list, tuple, dict)) and pd.isna(v)):
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if os.environ.get("ORACLE_EXACT") else round(v, 6)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v


def normalise(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm_value(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name: str, sf_dir: str, query, sql: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_pd = pd.DataFrame([r.asDict() for r in sdf.collect()], columns=s_cols)
    t1 = time.time()
    o_pd = con.execute(sql).fetchdf()
    if sorted(s_cols) != sorted(o_pd.columns):
        return False, f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_pd.columns)}"
    if len(s_pd) != len(o_pd):
        return False, f"row count spark={len(s_pd)} oracle={len(o_pd)}"
    a, b = normalise(s_pd), normalise(o_pd)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diffs}"
    return True, f"{len(s_pd)} rows, spark {t1 - t0:.2f}s"


def main(argv):
    from tessera.session import build_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            print(f"SKIP {n}: no oracle")
            continue
        try:
            ok, msg = compare(spark, con, n, sf_dir, qs[n], sqls[n])
        except Exception as e:  # report and continue with the next query
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {n}: {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
